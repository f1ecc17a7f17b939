"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

import public_tokenizers
from loadkit.session import work_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dedup, html_text, language, manifest, merkle, mixing, packing, runs, secrets, simhash, token_files, toxicity, warc
from .common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return add


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query(
    "op3_exact_dedup",
    """
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
        doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
    FROM t
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(table(spark, sf_dir, "documents"), work_path(spark, "token-files"), VOCABULARY)
    return token_files.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, drawn = mixing.mix(table(spark, sf_dir, "documents"))
    words = drawn.groupBy("locator").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("blocks"))
    found = known.join(words, "locator", "left")
    zero = F.lit(0).cast("long")
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"), F.coalesce("blocks", zero).alias("blocks"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out)
    found = toxicity.score(docs, model, ["doc_id"])
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "span_start", "span_end")


@query("op5_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    prototypes = language.learn(docs, held_out)
    found = language.identify(docs, prototypes, ["doc_id"])
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op6_merkle")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.edited(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumns({"n_chars": F.char_length("text").cast("long"), "n_lines": F.size(F.split("text", "\n")).cast("long")})


@query("op11_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = runs.find(docs, ["doc_id"], runs.planted(docs))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    # the greatest of (length, -start, -period)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
    SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), work_path(spark, "warc"), "2024-01-31T00:00:00Z")
    found = warc.read(archives, payload=False)
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op13_manifest",
    """
    WITH RECURSIVE docs AS (
        SELECT *, xor(list_reduce(list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1))::BIGINT),
            lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295) % 7 = 0 AS touched
        FROM documents
    ),
    rows AS (
        SELECT doc_id, lang, touched, n_chars,
            concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head,
            coalesce(strlen(text) || ':' || text, '-') AS tail
        FROM docs
    ),
    leaves AS (
        SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
            sha256(head || CASE WHEN n_chars IS NULL THEN '-' WHEN touched THEN strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS altered
        FROM rows
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
    nodes AS (
        SELECT lang, 0 AS lvl, r AS idx, n, leaf AS h FROM placed
        UNION ALL
        SELECT lang, lvl + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 2
    ),
    subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS lvl, r AS idx, n, h FROM subroots
        UNION ALL
        SELECT lvl + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 2
    ),
    steps AS (
        SELECT p.lang, p.r, own.lvl, CASE WHEN s.h IS NULL THEN '-' WHEN s.idx < own.idx THEN 'L' || s.h ELSE 'R' || s.h END AS step
        FROM placed p JOIN nodes own ON own.lang IS NOT DISTINCT FROM p.lang AND own.n > 1 AND own.idx = p.r >> own.lvl
        LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM own.lang AND s.lvl = own.lvl AND s.idx = xor(own.idx, 1)
    ),
    paths AS (SELECT lang, r, list(step ORDER BY lvl) AS path FROM steps GROUP BY lang, r),
    over_paths AS (
        SELECT p.r, list(CASE WHEN s.h IS NULL THEN '-' WHEN s.idx < own.idx THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY own.lvl) AS path
        FROM subroots p JOIN tops own ON own.n > 1 AND own.idx = p.r >> own.lvl LEFT JOIN tops s ON s.lvl = own.lvl AND s.idx = xor(own.idx, 1) GROUP BY p.r
    ),
    proved AS (
        SELECT p.*, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, list_concat(coalesce(a.path, CAST([] AS VARCHAR[])), coalesce(b.path, CAST([] AS VARCHAR[]))) AS path
        FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
        LEFT JOIN paths a ON a.lang IS NOT DISTINCT FROM p.lang AND a.r = p.r LEFT JOIN over_paths b ON b.r = s.r
    ),
    told AS (
        SELECT *, list_reduce(path, lambda own, step: sha256(CASE step[1] WHEN '-' THEN own WHEN 'L' THEN step[2:] || own ELSE own || step[2:] END), altered) AS folded_root FROM proved
    )
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(list_filter(path, lambda s: s <> '-'), lambda s: s[2:]), '')) AS proof_sha256,
        folded_root, folded_root = root AS verified
    FROM told
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    _, found = manifest.manifest(docs, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"n_chars": touched()})
    return proof_digests(found)


def touched() -> Column:
    """n_chars as tampering leaves it."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


def proof_digests(found: DataFrame) -> DataFrame:
    found = manifest.folded(found, "altered", "folded_root")
    return found.select(
        F.col("order").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
