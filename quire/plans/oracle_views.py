"""DuckDB restatements of the derived views, used by the oracle SQL.

They mirror ``quire.sources.tables`` column for column, so both engines read
identical rows.
"""

PAPERS = """papers AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         split_part(text, chr(10), 1) AS title,
         text AS summary,
         source AS primary_category,
         string_split(concat(source, ',src', CAST((doc_id*7+3) % 20 AS VARCHAR)), ',') AS categories,
         concat('Author ', CAST(doc_id % 37 AS VARCHAR), ', Author ', CAST((doc_id*5) % 41 AS VARCHAR)) AS authors,
         lang AS language,
         DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS date,
         doc_id AS seq
  FROM documents)"""

EVENT_FEED = """feed AS (
  SELECT concat(CAST(user_id AS VARCHAR), ':', event_type) AS id,
         CAST(ts AS DATE) AS date, event_id AS seq, event_type, value, props
  FROM events)"""

DOC_FEED = """dfeed AS (
  SELECT md5(text) AS id, DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS date,
         doc_id AS seq, source, lang
  FROM documents)"""


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
