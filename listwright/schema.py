"""Schemas of the engine's tables and payloads as DDL; nothing is inferred."""

POSTING = "id string, source string, company_name string, title string, origin_url string, location string, posted_at date, status string, raw_html string, first_seen_at timestamp_ntz, last_updated_at timestamp_ntz, deadline date"
MASTER = f"{POSTING}, last_seen_date date"
CATEGORY = "job_id string, primary_category string, min_experience int, max_experience int, salary_min int, salary_max int, work_type string, company_revenue int, company_size int, key_requirements array<string>, preferred_skills array<string>, tools_used string, ai_summary string, preferred_certifications array<string>, preferred_skills_tags array<string>"
STORED_CATEGORY = f"{CATEGORY}, source string, rules_md5 string, as_of timestamp_ntz"
REGISTRY = "source string, company string, form string, board string, aliases array<string>"
RUN_LOG = "run_id bigint, run_date date, newly_added int, modified_count int, closed_count int, is_success boolean, error_log string, source_counts string, successful_sources string"

JOBS_BOARD = "jobs array<struct<id: bigint, title: string, absolute_url: string, content: string, location: struct<name: string>, updated_at: string, first_published: string>>"
LISTS_BOARD = "array<struct<id: string, text: string, hostedUrl: string, descriptionPlain: string, lists: array<struct<text: string, content: string>>, categories: struct<location: string>, createdAt: bigint>>"
DATAS_BOARD = "data struct<datas: array<struct<id: bigint, title: string, openingDate: string, dueDate: string, place: string>>>"
COMPANY_API = "list array<struct<seq: bigint, subject: string, content1: string, content2: string, wdate: string>>"
