"""Schemas of the tables that operators read."""

ITEMS = (
    "doc_id string, item_idx int, type string, sub_type string, text string, text_level int, page_idx int, bbox array<double>, list_items array<string>, "
    "content string, body string, code_body string, table_body string, has_table_body boolean, table_caption array<string>, image_caption array<string>, "
    "image_footnote array<string>, chart_caption array<string>, chart_footnote array<string>, img_path string, "
    "orig_text string, orig_list_items array<string>, orig_type string, orig_table_body string, had_table_body boolean, repaired_at string"
)
PAGES = "doc_id string, page_pos int, page_idx int, page_size array<double>"
GATE = "struct<state: string, value: double, threshold: double, note: string, at: string, previous: struct<state: string, value: double, at: string>>"
LEDGER = f"doc string, pdf_sha256 string, gates map<string, {GATE}>"
JOBS = "job_id string, candidate_id string, filename string, source_sha256 string, status string, decision string, reasons array<string>, details array<string>, created_at string, created_epoch double, updated_at string, processed_index int, error string, stage_started_at string, workspace string"
EVENTS = "event_id string, created_at string, processed_index int, job_id string, document string, reason string, detail string"
CHUNKS = "id string, content string, workspace string"
ENTITIES = "entity_name string, entity_type string, chunk_ids array<string>, file_path string"
RELATIONS = "source_id string, target_id string, chunk_ids array<string>, file_path string"
EQUATIONS = "doc string, item int, latex string, source string"
TOC = "doc string, pos int, level int, title string, page int"
SPANS = "doc string, page int, line int, span int, text string, size double"
DECISIONS = "doc string, section string, index int, category string, reason string, text string, page int, suppress boolean, decided_by string, note string"
