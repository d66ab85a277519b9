"""The registry of sources as a table: one row for each board, with the names it goes by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.schema import REGISTRY

# Boards of companies. (source, company, form of the payload, the board's own number or name)
BOARDS = (
    ("krafton", "크래프톤", "jobs", "krafton"), ("neowiz", "네오위즈", "lists", "neowiz"), ("kakaogames", "카카오게임즈", "datas", "7144"), ("111percent", "111퍼센트", "datas", "2836"), ("supercent", "슈퍼센트", "datas", "2730"), ("epidgames", "에피드게임즈", "datas", "16500"),
    ("nexon", "넥슨", "anchors", "1882711"), ("ncsoft", "엔씨소프트", "anchors", "1926620"), ("netmarble", "넷마블", "anchors", "1753968"), ("com2us", "컴투스", "anchors", "1547724"), ("webzen", "웹젠", "anchors", "1798146"), ("wemade", "위메이드", "anchors", "1977592"),
    ("devsisters", "데브시스터즈", "anchors", "16152377"), ("smilegate", "스마일게이트", "anchors", "16152306"), ("gravity", "그라비티", "anchors", "1605140"), ("doubleugames", "더블유게임즈", "anchors", "16152348"), ("neople", "네오플", "anchors", "1713050"), ("joycity", "조이시티", "anchors", "1504762"),
    ("linegames", "라인게임즈", "anchors", "16154364"), ("nhn", "NHN", "anchors", "1546668"), ("nexongames", "넥슨게임즈", "anchors", "42943938"), ("mgame", "엠게임", "anchors", "1694830"), ("me2on", "미투온", "anchors", "42868646"), ("actozsoft", "액토즈소프트", "anchors", "1530478"),
    ("wemademax", "위메이드맥스", "anchors", "1522311"), ("wemadeplay", "위메이드플레이", "anchors", "16152762"), ("vicgamestudios", "빅게임스튜디오", "anchors", "48077192"), ("hybeim", "하이브IM", "anchors", "49122801"),
)
# Other names on a board's own pages.
ALIASES = {"ncsoft": ("NC", "엔씨소프트"), "nhn": ("엔에이치엔", "NHN"), "hybeim": ("하이브아이엠", "하이브IM", "DRIMAGE", "드림에이지")}


def source_registry(spark: SparkSession, boards: Sequence[tuple[str, str, str, str]] = BOARDS, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """(source, company, form, board, aliases): the company's name is its first alias, and each counts once."""
    more = ALIASES if aliases is None else aliases
    return spark.createDataFrame([(*b, list(dict.fromkeys([b[1], *more.get(b[0], ())]))) for b in boards], REGISTRY)


def registry_problems(registry: DataFrame) -> DataFrame:
    """(source, problem) of rows that would mix up sources: duplicate source, duplicate board, no alias."""
    times = lambda *keys: registry.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    boards = registry.join(times("form", "board"), ["form", "board"], "left_semi").select("source", F.lit("duplicate board").alias("problem"))
    none = registry.where(F.coalesce(F.size(F.filter("aliases", lambda a: F.trim(a) != "")), F.lit(0)) <= 0).select("source", F.lit("no alias").alias("problem"))
    return times("source").select("source", F.lit("duplicate source").alias("problem")).unionByName(boards).unionByName(none)


def aliases_of(registry: DataFrame) -> DataFrame:
    """(source, alias), as the page guardrail takes them."""
    return registry.select("source", F.explode("aliases").alias("alias"))
