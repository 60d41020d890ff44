"""Record-shaped tables from the given ones: SELECTs that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

ENTITIES = "SELECT md5(r_name) AS id, r_name AS name, CAST(r_regionkey AS STRING) AS identifier FROM region"
TARGETS = "SELECT md5(concat(r_name, '|', n_name)) AS id, md5(r_name) AS entity_id, n_name AS target_name, r_name AS entity_name, 'ZA' AS location, 'court' AS target_type FROM nation JOIN region ON n_regionkey = r_regionkey"
RECORDS = """SELECT o_orderkey AS id, md5(concat(r_name, '|', n_name)) AS target_id, o_orderpriority AS record_type,
  CASE WHEN o_orderstatus = 'O' THEN 'indexed' ELSE 'detailed' END AS status, CAST(o_orderdate AS DATE) AS document_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
PAYLOADS = """SELECT d.doc_id AS id, d.source AS target_name, d.lang AS record_type, CASE WHEN l.doc_id IS NOT NULL THEN 'detailed' ELSE 'indexed' END AS status, d.text AS full_text,
  CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE concat('https://h/za/cases/', d.source, '/', CAST(2000 + d.doc_id % 20 AS STRING), '/', CAST(d.doc_id AS STRING), CASE WHEN d.doc_id % 4 = 0 THEN '.pdf' ELSE '.html' END) END AS source_url,
  CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE CAST(2000 + d.doc_id % 20 AS INT) END AS rec_year,
  concat('{"category":"', CASE WHEN d.doc_id % 3 = 0 THEN 'cases' ELSE 'gaz' END, '"', CASE WHEN d.doc_id % 7 <> 0 THEN concat(',"dataset_number":"', CAST(d.doc_id % 500 AS STRING), '/20"') ELSE '' END,
    CASE WHEN d.doc_id % 5 = 0 THEN ',"details_scraped_at":"2024-01-01"' ELSE '' END, CASE WHEN d.doc_id % 6 = 0 THEN ',"citations":[1]' ELSE '' END, '}') AS data,
  1704067200 + d.doc_id * 60 AS scraped_s, CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.doc_id % 11 = 0 END AS requires_human_review,
  CASE WHEN d.doc_id % 22 = 0 THEN 'Document parsing failed' WHEN d.doc_id % 11 = 0 THEN 'other' END AS review_reason
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
JUDGMENTS = """SELECT o_orderkey AS id, n_name AS court, r_name AS division, concat('Judge ', CAST(o_custkey % 20 AS STRING)) AS judge, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS outcome,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 3 = 0 END AS reportable, CAST(o_orderdate AS DATE) AS judgment_date,
  concat(CAST(o_orderkey AS STRING), '/', CAST(2000 + o_orderkey % 30 AS STRING)) AS dataset_number, concat(o_orderpriority, ',', c_mktsegment) AS subject_list
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
MASTER = "SELECT p_partkey AS place, concat('P', CAST(p_partkey % 1500 AS STRING), CASE WHEN p_partkey % 40 = 0 THEN '-MANTECH-EC' ELSE '' END) AS stock_code, p_name AS description, CAST(p_retailprice AS STRING) AS price FROM part"
OTHER = "SELECT p_partkey AS place, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE concat('P', CAST(p_partkey % 700 AS STRING)) END AS part_number, concat('https://img/', CAST(p_partkey AS STRING)) AS image_url, CAST(p_size AS STRING) AS price, CASE WHEN p_partkey % 2 = 0 THEN '9.99' END AS compare_at_price FROM part WHERE p_partkey % 3 = 0"


def _store(keep: str, times: str) -> str:
    return f"""SELECT id, source_url, data, CASE WHEN id % {times} < 2 THEN 'detailed' ELSE 'indexed' END AS status, CASE WHEN id % {times} < 2 THEN scraped_s + 3600 END AS detailed_at, CASE WHEN id % 6 = 1 THEN scraped_s + 7200 END AS parsed_at,
  CAST(NULL AS BIGINT) AS scrubbed_at, requires_human_review, review_reason FROM ({PAYLOADS}) p WHERE {keep}"""


SECONDARY, STORE_MASTER = _store("id % 3 <> 0", "4"), _store("id % 2 = 0", "5")


class Tables:
    """Given and record-shaped tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, select: str) -> DataFrame:
        """A SELECT over the given tables."""
        used = {t: self[t] for t in GIVEN if re.search(rf"(?i)\b(?:FROM|JOIN)\s+{t}\b", select)}
        named = re.sub(rf"(?i)\b(FROM|JOIN)\s+({'|'.join(GIVEN)})\b(?!\s+AS\b)(\s+(?!ON\b|JOIN\b|LEFT\b|WHERE\b|GROUP\b|ORDER\b|CROSS\b|UNION\b)[A-Za-z_]\w*)?", lambda m: f"{m[1]} {{{m[2]}}}{m[3] or ' AS ' + m[2]}", select.replace("{", "{{").replace("}", "}}"))
        return self.spark.sql(named, **used)

    def records(self) -> DataFrame:
        return self.sql(RECORDS)

    def targets(self) -> DataFrame:
        return self.sql(TARGETS)

    def entities(self) -> DataFrame:
        return self.sql(ENTITIES)

    def payloads(self) -> DataFrame:
        return self.sql(PAYLOADS).withColumn("scraped_at", F.timestamp_seconds("scraped_s"))

    def judgments(self) -> DataFrame:
        return self.sql(JUDGMENTS).withColumn("subjects", F.split("subject_list", ","))

    def child(self, kind: str) -> DataFrame:
        """Parsed rows of ids not divisible by 4, scrubbed rows of those divisible by 5."""
        keep = {"parsed": "doc_id % 4 <> 0", "scrubbed": "doc_id % 5 = 0"}[kind]
        return self["documents"].where(keep).select(F.col("doc_id").alias("extracted_record_id"), F.to_json(F.struct(F.lit(kind).alias("kind"))).alias("data"))
