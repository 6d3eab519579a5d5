"""The registered queries ``opN_<name>``; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, html, manifest, mixing, neighbours, packing, quality, sharding, simhash, tokenfile, toxicity, warc, whitening
from .manifest_sql import MANIFEST_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of a document in the mixture: epoch, block, and the block's place in the epoch."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs).select(
        "doc_id", "source", F.col("_mix_epoch").alias("epoch"), F.col("_mix_block").alias("block"),
        F.col("_mix_order").alias("block_order"), F.col("_mix_weight").alias("weight"),
    )


@query
def op8_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 ids."""
    return packing.packed(_table(spark, sf_dir, "documents"))


@query
def op2_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files: place, number and checksum of their ids."""
    return tokenfile.token_files(_table(spark, sf_dir, "documents"))


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as read back from the archives."""
    read = warc.archived(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op5_warc_round_trip"] = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM payloads
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests
)
SELECT
  page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


@query
def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(_table(spark, sf_dir, "pages"))


@query
def op7_uniform_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.uniform_shards(_table(spark, sf_dir, "documents"))


@query
def op9_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


@query
def op4_pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every 100th one."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document; a third of them are checked with a changed text."""
    return manifest.checked(_table(spark, sf_dir, "documents"))


ORACLES["op11_merkle_manifest"] = MANIFEST_SQL


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every usable embedding, a row per component."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
