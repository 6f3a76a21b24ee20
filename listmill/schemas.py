"""Schemas of the stored tables."""

LISTINGS = """id bigint, source string, source_id string, url string, acronym string, name string,
  start_date date, end_date date, location_raw string, city string, country string,
  homepage string, description string, abstract_deadline date, paper_deadline date,
  notification_date date, camera_ready_deadline date, registration_deadline date,
  categories array<string>, extra string, in_window boolean, is_topic boolean,
  topic_reason string, entity_id bigint, first_seen_at timestamp, last_seen_at timestamp"""

ENTITIES = """id bigint, acronym string, name string, start_date date, end_date date, city string,
  country string, location_raw string, description string, abstract_deadline date,
  paper_deadline date, notification_date date, camera_ready_deadline date,
  registration_deadline date, homepage string, registration_url string, fee_min double,
  fee_max double, currency string,
  field_sources map<string, struct<source:string, url:string>>, status string,
  review_note string, enriched_at timestamp, read_fingerprint string,
  history struct<has_history:boolean, note:string,
    editions:array<struct<year:int, name:string, publisher:string, doi:string>>,
    publishers:array<string>>,
  attendance struct<mode:string,
    evidence:array<struct<source:string, says:string, text:string>>>"""

FEES = """id bigint, entity_id bigint, category string, tier string, amount double,
  currency string, notes string, source string, source_url string, check_status string,
  check_note string, evidence string"""

PAGES = """url string, final_url string, status_code int, content_type string, html string,
  fetched_at timestamp"""

RUNS = """id bigint, kind string, source string, status string, params string, stats string,
  error string, started_at timestamp, finished_at timestamp, idempotency_key string"""

EXTRACTED_FEES = "array<struct<category:string, tier:string, amount:double, currency:string, notes:string>>"
