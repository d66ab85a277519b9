"""Rules as data: dictionaries, markers and thresholds of all operators.

The defaults are for Korean finance listings of game companies. Every operator takes a Rules,
so other domains pass their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TitleRules:
    """Deny words (any case), then allow words (exact case / any case), patterns, whole words."""

    deny: tuple[str, ...]
    allow_exact: tuple[str, ...] = ()
    allow_any_case: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    whole_words: tuple[str, ...] = ()


@dataclass(frozen=True)
class CompanyRules:
    deny: tuple[str, ...]
    deny_context: tuple[str, ...]
    allow: tuple[str, ...]


# Titles.
FINANCE_TITLES = TitleRules(
    deny=(
        "딜러", "dealer", "식음료", "f&b", "객실", "서빙", "바텐더", "벨맨", "캐셔", "카운터", "알바", "아르바이트", "안내데스크", "안내 데스크",
        "legal", "counsel", "compliance", "인사", "recru", "채용담당", "채용 담당", "변호사", "준법", "공정거래", "보상", "급여", "pmo", "비서", "총무",
        "개발자", "개발 담당", "개발담당", "시스템 개발", "프로그래머", "엔지니어", "developer", "programmer", "engineer",
    ),
    allow_exact=("재무", "회계", "세무", "자금", "경리", "결산", "내부회계", "내부통제", "재무기획", "자금운용", "원가", "회계사", "세무사"),
    allow_any_case=("finance", "financial", "accounting", "accountant", "tax", "treasury", "payroll", "fp&a"),
    patterns=(r"(내부\s?감사|회계\s?감사|상근\s?감사|외부\s?감사|감사\s?담당|감사팀|감사실|감사역|감사\s?업무)", r"(재무\s?공시|회계\s?공시|기업\s?공시)"),
    whole_words=("ir",),
)

# Companies.
GAME_COMPANIES = CompanyRules(
    deny=("람정", "신화월드", "카지노", "casino", "호텔", "hotel", "리조트", "resort", "홀덤", "보드게임카페", "보드카페", "멀티방", "오락실"),
    deny_context=("딜러", "dealer", "식음료", "f&b", "객실", "서빙", "바텐더", "벨맨", "캐셔", "카운터", "알바", "아르바이트"),
    allow=(
        "게임", "game", "nexon", "krafton", "ncsoft", "netmarble", "neowiz", "smilegate", "펄어비스", "위메이드", "카카오게임즈", "그라비티", "넥슨", "크래프톤", "엔씨소프트",
        "넷마블", "네오위즈", "스마일게이트", "데브시스터즈", "컴투스", "웹젠", "조이시티", "한빛소프트", "썸에이지", "해긴", "쿡앱스", "클로버게임즈", "시프트업", "라인게임즈",
        "더블유게임즈", "레드브릭", "엔씨", "com2us", "wemade", "gravity", "kakaogames", "pearlabyss", "webzen", "shiftup", "linegames", "joycity", "액션스퀘어",
        "위메이드맥스", "위메이드플레이", "컴투스홀딩스", "컴투스플랫폼", "nhn", "엔에이치엔", "네오플", "아이덴티티", "그라비티네오싸이언", "웹젠레드코어", "웹젠블루포트",
        "하이브im", "hybeim", "빅게임스튜디오", "vicgamestudios", "vic game",
    ),
)

# Work types, first hit wins.
WORK_TYPES = (
    ("풀재택", (r"풀재택", r"전면재택", r"100%\s*(재택|리모트|원격)", r"상시재택", r"완전재택", r"완전\s*리모트", r"상시\s*리모트")),
    ("하이브리드 (주2~3회 재택)", (r"하이브리드", r"주\s*\d\s*(회|일)\s*재택", r"주\s*\d\s*(회|일)\s*리모트", r"일주일에\s*\d\s*(회|일)\s*재택", r"부분\s*재택", r"재택\s*혼용", r"리모트\s*근무", r"재택\s*가능")),
    ("전면출근", (r"전면\s*출근", r"사무실.{0,10}출근", r"오피스.{0,10}출근", r"출근\s*필수", r"매일\s*출근", r"상주\s*근무", r"전\s*직원\s*출근", r"재택\s*(근무)?\s*(는)?\s*(없|불가|미실시|미운영)")),
)

# Categories by title, first hit wins.
CATEGORIES = (("세무", ("세무", "tax", "부가세")), ("재무/자금", ("자금", "재무", "treasury", "투자")), ("내부통제", ("통제", "내부회계", "sox")))

# Company presets (name, revenue, size), in order, and fallbacks by part of the name.
COMPANY_PRESETS = (
    ("더블유게임즈", 6335, 394), ("시프트업", 1600, 290), ("넥슨", 35000, 1500), ("넥슨코리아", 35000, 1500), ("넥슨게임즈", 2561, 1459), ("크래프톤", 19000, 1600),
    ("엔씨소프트", 17000, 4000), ("넷마블", 25000, 800), ("카카오게임즈", 10000, 450), ("네오위즈", 3600, 900), ("네오플", 13784, 1402), ("데브시스터즈", 1600, 360),
    ("컴투스", 7000, 1000), ("펄어비스", 3800, 800), ("그라비티", 5008, 414), ("조이시티", 1429, 365), ("라인게임즈", 435, 147), ("NHN", 24561, 893), ("위메이드", 6089, 500), ("스마일게이트", 13700, 1200),
)
COMPANY_FALLBACKS = (("컴투스", "컴투스"), ("com2us", "컴투스"), ("위메이드", "위메이드"), ("wemade", "위메이드"), ("넥슨", "넥슨"), ("nexon", "넥슨"), ("스마일게이트", "스마일게이트"), ("smilegate", "스마일게이트"), ("하이브", "NHN"), ("hybe", "NHN"))


@dataclass(frozen=True)
class Rules:
    titles: TitleRules = FINANCE_TITLES
    companies: CompanyRules = GAME_COMPANIES
    work_types: tuple[tuple[str, tuple[str, ...]], ...] = WORK_TYPES
    work_type_unknown: str = "미확인"
    categories: tuple[tuple[str, tuple[str, ...]], ...] = CATEGORIES
    category_default: str = "회계"
    # Bodies.
    body_markers: tuple[str, ...] = ("담당업무", "자격요건", "우대사항", "주요업무")
    extra_body_markers: tuple[str, ...] = ("지원자격", "필수요건", "모집부문", "근무조건", "모집분야", "전형절차", "제출서류")
    navigation: tuple[str, ...] = ("커리어의 시작, 사람인", "중장년 채용", "기업서비스", "역세권별", "인적성")
    # Words of a body, and what follows it.
    body_allow: tuple[str, ...] = ("게임", "game")
    tail_markers: tuple[str, ...] = ("저작권자", "무단전재", "진행중인 채용", "이 기업의 다른 공고", "기업뉴스", "정확한 정보는 기업공시", "실시간 정보와 상이할 수 있", "면접후기", "에서 게재한 자료에 대한 오류")
    contact: str = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|01[0-9][-.\s]?\d{3,4}[-.\s]?\d{4}|0\d{1,2}[-.\s]\d{3,4}[-.\s]\d{4}"
    closed_badge: str = r"마감\s*\(~"
    # Experience.
    requirement_start: tuple[str, ...] = ("자격요건", "자격 요건", "지원자격", "지원 자격", "필수요건", "필수 요건")
    requirement_end: tuple[str, ...] = ("우대사항", "우대 사항", "우대조건", "복지 및 혜택", "복리후생", "채용절차", "전형절차", "접수기간", "기타사항")
    requirement_chars: int = 2000
    most_years: int = 40
    ranks: tuple[tuple[str, int], ...] = (("부장", 12), ("차장", 9), ("과장", 6), ("대리", 3), ("주임", 2))
    # Section headers and dictionaries.
    section_requirements: tuple[str, ...] = ("자격요건", "지원자격", "필수요건", "이런 분을 찾습니다", "자격 요건")
    section_preferences: tuple[str, ...] = ("우대사항", "우대 조건", "이런 분이면 더 좋습니다", "우대 요건")
    section_other: tuple[str, ...] = ("근무조건", "근무 조건", "복지 및 혜택", "복리후생", "복지혜택", "채용절차", "전형절차", "접수기간", "제출서류", "유의사항", "기업정보", "기타사항")
    tools: tuple[str, ...] = ("sap", "더존", "douzone", "oracle", "영림원", "excel", "엑셀", "ifrs", "gap")
    certificates: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("CPA", ("cpa", "한국공인회계사", "공인회계사")), ("AICPA", ("aicpa", "uscpa", "미국공인회계사")), ("CTA", ("cta", "세무사")), ("CFA", ("cfa", "재무분석사")), ("FRM", ("frm", "재무위험관리사")),
    )
    skills: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("IFRS", ("ifrs", "국제회계기준", "k-ifrs")), ("연결회계", ("연결", "consolidation", "연결결산")), ("공시", ("공시", "disclosure", "dart")), ("내부회계", ("내부회계", "내부통제", "sox", "내부회계관리제도")),
        ("세무조사", ("세무조사", "tax audit")), ("자금조달", ("조달", "funding", "차입")), ("원가회계", ("원가", "cost accounting")),
    )
    # Keys.
    legal_forms: tuple[str, ...] = ("(주)", "주식회사", "㈜", "（주）")
    company_aliases: tuple[tuple[str, str], ...] = (("nx3games", "엔엑스쓰리게임즈"),)
    presets: tuple[tuple[str, int, int], ...] = COMPANY_PRESETS
    preset_fallbacks: tuple[tuple[str, str], ...] = COMPANY_FALLBACKS
    platforms: tuple[str, ...] = ("wanted", "saramin", "jobkorea", "gamejob")
    known_blocks: tuple[tuple[str, str, str], ...] = (("wanted", "2026-07-16", "러너 IP 차단"),)
    # Thresholds.
    body_least_chars: int = 120
    degraded_ratio: float = 0.7
    collapse_least_chars: int = 400
    collapse_factor: int = 3
    repost_gap_days: int = 2
    close_grace_days: int = 2
    close_least_seen: int = 3
    zeroed_least_active: int = 2
    zeroed_most_sources: int = 4
    baseline_days: int = 7
    drop_least_days: int = 3
    drop_least_average: float = 3.0
    drop_ratio: float = 0.3
    stale_days: int = 14
    urgent_days: int = 3
    compact_over: int = 15
    bullets_each: int = 5
    fetch_budget: int = 12
    due_most_days: int = 365
    family_least: int = 3


DEFAULT = Rules()
