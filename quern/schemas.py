"""Schemas of the tables and records that the operators work on, as Spark DDL."""

from __future__ import annotations

_SCORES = "content_cleaned STRING, badness_score DOUBLE, greek_percentage DOUBLE, english_percentage DOUBLE"
_TIMES = "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
_LEGAL = f"id BIGINT, title STRING, url STRING, type STRING, content STRING, extraction_method STRING, {_SCORES}, publication_date TIMESTAMP_NTZ, source STRING, {_TIMES}"

SCHEMAS = {
    "ministries": "id BIGINT, code STRING, name STRING, url STRING",
    "consultations": "id BIGINT, post_id STRING, title STRING, start_minister_message STRING, end_minister_message STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ, is_finished BOOLEAN, url STRING, total_comments INT, accepted_comments INT, ministry_id BIGINT",
    "articles": f"id BIGINT, title STRING, url STRING, content STRING, raw_html STRING, extraction_method STRING, {_SCORES}, consultation_id BIGINT, {_TIMES}",
    "comments": "id BIGINT, comment_id STRING, username STRING, date TIMESTAMP_NTZ, content STRING, extraction_method STRING, article_id BIGINT",
    "documents": f"id BIGINT, title STRING, url STRING, file_path STRING, status STRING, type STRING, content_type STRING, content STRING, processed_text STRING, extraction_method STRING, {_SCORES}, consultation_id BIGINT, {_TIMES}",
    "laws": f"{_LEGAL}, law_number STRING",
    "ministerial_decisions": f"{_LEGAL}, decision_number STRING, ministry STRING",
    "presidential_decrees": f"{_LEGAL}, decree_number STRING",
    "eu_regulations": f"{_LEGAL}, regulation_number STRING, eu_year INT",
    "eu_directives": f"{_LEGAL}, directive_number STRING, eu_year INT",
    "law_catalogue": "id BIGINT, law_type STRING, law_number STRING, description STRING, fek_title STRING, fek_url STRING, date STRING, entry_year INT, pages STRING, preferred_url STRING, download_success BOOLEAN, filename STRING, download_error STRING, download_retry_count INT, extraction STRING, processing_stage STRING, markdown_content STRING, content_size INT, created_at TIMESTAMP_NTZ",
    "gazette_segments": "filename STRING, title STRING, content STRING, article_num BIGINT, sequence STRING",
    "table_issues": "file_path STRING, issue_description STRING, table_start_line INT, table_end_line INT",
    "sections": "consultation_id BIGINT, id BIGINT, title STRING, part STRING, chapter STRING",
    "listing": "url STRING, title STRING, date STRING",
}
