"""Schemas of the record tables, as DDL; never inferred."""

from __future__ import annotations

ENTITIES = "id string, name string, identifier string, created_at timestamp"
TARGETS = "id string, entity_id string, target_name string, location string, target_type string, created_at timestamp"
RECORDS = (
    "id string, target_id string, document_date date, record_type string, data string, requires_human_review boolean, review_reason string, source_url string, status string, "
    "scraped_at timestamp, detailed_at timestamp, parsed_at timestamp, scrubbed_at timestamp, updated_at timestamp"
)
CHILD = "extracted_record_id string, data string, created_at timestamp, updated_at timestamp"
SECTIONS = "null_values array<string>, header string, judgment string, `order` string, appearances string, footnotes struct<raw_text:string,targets:array<struct<text:string,url:string>>>"
PRECEDENT = "raw_citation string, case_name string, case_number string, neutral_citation string, commercial_citations array<string>, decision_date string, treatment string, reasoning string, url string"
JUDGMENTS = (
    "dataset_number string, court string, division_location string, judge string, judgment_date string, reportable boolean, parties struct<applicant_plaintiff:string,respondent_defendant:string>, "
    "subjects array<string>, result struct<outcome_type:string,costs_order:string>, ai_metadata struct<keywords:array<string>>"
)
PAGES = "page_id long, url string, html string"
DRAWS = "Year string, Date string, `Winning Numbers` string, Jackpot string, Outcome string"
TABLES = {"entities": ENTITIES, "targets": TARGETS, "extracted_records": RECORDS, "parsed_records": CHILD, "scrubbed_records": CHILD, "pages": PAGES}
