"""Registered queries of the pipeline operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import contained, language, lines, merkle, near, periods, pieces, quality, repeats, search, secrets, sharding, tokens

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"))
    found = language.identify(docs, language.fit(docs.filter(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, counted and digested per kind."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = secrets.spans_text(F.filter("found", lambda x: x["kind"] != "lexed"))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"),
        secrets.spans_text(F.col("found")).alias("spans"),
    )


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 16 equal shards, and their shard among 17."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * 16, [1.0] * 17)


# The score of equal weights rises with the hash, so the best shard has the largest hash.
_HASH = "('0x' || substr(md5(CAST({} AS VARCHAR) || '/{}'), 1, 13))::BIGINT"
_BEST = "CAST(list_position([{0}], greatest({0})) - 1 AS INTEGER)"


def _shard_sql(n: int) -> str:
    return _BEST.format(", ".join(_HASH.format("doc_id", s) for s in range(n)))


ORACLES["op3_sharding"] = f"""
WITH RECURSIVE crc_step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM crc_step WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_step WHERE k = 8),
placed AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
         hex(encode(coalesce(text, ''))) AS digits, {_shard_sql(16)} AS shard, {_shard_sql(17)} AS grown_shard,
         CAST(floor(({_HASH.format("doc_id", "slot")} + 0.5) / 4503599627370496.0
                    * (SELECT greatest(1, ceil(count(*) / 50000.0)) FROM documents)) AS BIGINT) AS bucket
  FROM documents
)
SELECT doc_id, size,
       CAST(xor(4294967295, list_reduce(
         list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(length(digits) / 2 AS BIGINT)),
           lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS BIGINT) AS text_crc32,
       'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id) - 1 AS slot, grown_shard
FROM placed, crc_table
"""


@query
def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of three consecutive lines."""
    found = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


ORACLES["op4_lines"] = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, pos, array_to_string(lines[pos + 1:pos + 3], chr(10)) AS run
  FROM (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS pos FROM split)
), later AS (
  SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS n FROM windows) WHERE n > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 3)) AS pos FROM later),
kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.pos) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split) s
  ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.pos = s.pos GROUP BY s.doc_id
)
SELECT s.doc_id, CAST(len(s.lines) AS BIGINT) AS n_lines, CAST(len(s.lines) - coalesce(k.n, 0) AS BIGINT) AS n_removed, coalesce(k.text, '') AS text
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 75 % of their five-word shingles in common."""
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids in token files, read back from them."""
    folder = tokens.new_folder(spark)
    docs = table(spark, sf_dir, "documents")
    parts = tokens.write_token_files(docs, tokenizer_file("byte_bpe_50k.json"), 0, folder, added=True)
    found = tokens.crc_of_tokens(tokens.read_token_files(spark, folder, len(parts)))
    return found.withColumnRenamed("key", "doc_id")


@query
def op7_benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items with three quarters of their five-word shingles in a document."""
    return contained.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside passages of 35 words that occur elsewhere too."""
    found = repeats.repeated_spans(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]))
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return search.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op9_top_vectors"] = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_file("piece_bpe_32k.model")
    found = pieces.encode(docs, model, seed=1, lossless="lossless")
    return found.select(
        "doc_id",
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.array_join("pieces", ","), 256).alias("pieces_sha256"),
        "lossless",
    )


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number, longest and digests of the runs of ``periods.periodic_runs``."""
    best = F.array_min(F.transform("runs", lambda x: F.struct((-x["length"]).alias("size"), x["start"], x["period"])))
    line = lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])
    listed = F.array_join(F.transform("runs", lambda x: F.concat(line(x), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.size) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, and its text with each run cut to one period."""
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    return run_digests(periods.periodic_runs(docs, repeat=F.when(h % 10 == 0, F.floor(h / 10))))


# crc32 of a decimal doc_id.
_CRC_TABLE = """RECURSIVE crc_step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM crc_step WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_step WHERE k = 8)"""
_KEY_CRC = """xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(CAST(doc_id AS VARCHAR))),
             lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT))),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"""

ORACLES["op11_periodic_runs"] = f"""
WITH {_CRC_TABLE},
hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         {_KEY_CRC} AS h
  FROM documents, crc_table
), asked AS (
  SELECT *, len(ws) AS n, h // 10 AS g, h % 10 = 0 AND len(ws) > 0 AS again, (h // 10) % greatest(1, len(ws)) AS a FROM hashed
), bent AS (
  SELECT doc_id, n, CASE WHEN again THEN list_transform(range(n), lambda i:
           ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE ws END AS ws
  FROM asked
), grams AS (
  SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(n - 5)) AS i FROM bent)
), pairs AS (SELECT x.doc_id, x.i, x.i - y.i AS lag FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i < x.i),
stretches AS (
  SELECT doc_id, lag, min(i) - lag AS start, lag + count(*) + 5 AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM pairs) GROUP BY doc_id, lag, island
), runs AS (
  SELECT doc_id, start, length, min(lag) AS period FROM stretches WHERE length >= 12 AND length >= 2 * lag GROUP BY doc_id, start, length
), sums AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
         first({{'s': start, 'l': length, 'p': period}} ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY doc_id
), gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS collapsed
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(n)) AS i FROM bent) w
  ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id
)
SELECT b.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
       1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM bent b LEFT JOIN sums s ON s.doc_id = b.doc_id LEFT JOIN kept k ON k.doc_id = b.doc_id
"""


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~out)
    found = quality.classify(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; each fifth is presented in lower case."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    seen = merkle.leaf_hash([*[F.col(c) for c in fields[:-1]], F.when(tampered, lower).otherwise(F.col("text"))])
    return merkle.manifest(docs, fields, presented=seen).drop("rank")


def _merkle_sql() -> str:
    """Both trees level by level; a tree of one node stays as it is, so that six levels hold 16 ** 6 leaves."""
    field = lambda x: f"coalesce(octet_length(encode(CAST({x} AS VARCHAR))) || ':' || {x}, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    steps = [
        _CRC_TABLE,
        f"""leaves AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
         CASE WHEN {_KEY_CRC} % 5 = 0 THEN {leaf(f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")} ELSE {leaf("text")} END AS cur
  FROM documents, crc_table
)""",
        """f0 AS (SELECT *, '' AS proof, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)""",
        """t0 AS (SELECT source, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM f0)""",
    ]

    def climb(f: str, t: str, levels: int, by: str) -> None:
        same = f"x.{by} IS NOT DISTINCT FROM r.{by}"
        cut = "CAST(64 * (x.pos % 16) AS BIGINT)"
        for k in range(levels):
            steps.append(f"r{t}{k} AS (SELECT {by}, pos // 16 AS grp, string_agg(digest, '' ORDER BY pos) AS run, any_value(n) AS n FROM {t}{k} GROUP BY {by}, pos // 16)")
            steps.append(f"{t}{k + 1} AS (SELECT {by}, grp AS pos, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS digest, (n + 15) // 16 AS n FROM r{t}{k})")
            left, right = f"left(r.run, {cut})", f"substr(r.run, {cut} + 65)"
            steps.append(
                f"{f}{k + 1} AS (SELECT x.* REPLACE (x.pos // 16 AS pos, CASE WHEN r.n > 1 THEN sha256({left} || x.cur || {right}) ELSE x.cur END AS cur, "
                f"CASE WHEN r.n > 1 THEN x.proof || {left} || {right} ELSE x.proof END AS proof) FROM {f}{k} x JOIN r{t}{k} r ON {same} AND r.grp = x.pos // 16)"
            )

    climb("f", "t", 6, "source")
    steps.append("tops AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t6)")
    steps.append("s0 AS (SELECT 0 AS one, pos, digest, n FROM tops)")
    steps.append("g0 AS (SELECT 0 AS one, f.* REPLACE (t.pos AS pos), t.digest AS subroot FROM f6 f JOIN tops t ON t.source IS NOT DISTINCT FROM f.source)")
    climb("g", "s", 6, "one")
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, leaf, subroot, s.digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = s.digest AS verified FROM g6, s6 s"
    )


ORACLES["op13_merkle_manifest"] = _merkle_sql()


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
