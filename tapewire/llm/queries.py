"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

URL_SQL = r"""
WITH judged AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
  (SELECT rule_host || rule_path FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) ORDER BY length(rule_host || rule_path) DESC LIMIT 1) AS rule,
  coalesce((SELECT verdict FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) ORDER BY length(rule_host || rule_path) DESC LIMIT 1), 'allow') AS verdict
FROM judged"""


@query("op4_url_filter", URL_SQL)
def op4_url_filter(spark, sf):
    """Host-suffix and path-prefix rules over every page url."""
    from tapewire.llm.url_filter import judge_urls, rule_table

    judged = judge_urls(table(spark, sf, "pages").select("page_id", "url"), rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op5_secret_scan")
def op5_secret_scan(spark, sf):
    """Base secrets and linked multipart credentials of every whole text."""
    from tapewire.llm import credentials as cr

    found = cr.find_spans(table(spark, sf, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        *[cr.count_kind(F.col("base"), k).alias(f"n_{k}") for k in cr.BASE],
        F.sha2(cr.span_text(F.col("base")), 256).alias("base_sha256"),
        cr.span_text(F.col("spans")).alias("spans"),
    )


@query("op8_source_mix")
def op8_source_mix(spark, sf):
    """All documents mixed to 150 % of all words, sources weighing 5, 2, 1 in turn."""
    from tapewire.llm.mixing import mix_plan

    return mix_plan(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_curve_packing")
def op3_curve_packing(spark, sf):
    """All documents packed into sequences of 1,024 tokens along a Hilbert curve."""
    from tapewire.llm.packing import pack_documents

    pieces = pack_documents(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), end=0, length=1024)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op9_token_files")
def op9_token_files(spark, sf):
    """Ids of all documents written as Simple-8b files in doc_id order and read back."""
    from tapewire.llm.token_files import read_ids, write_ids

    rows = read_ids(write_ids(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), end=2))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op1_warc")
def op1_warc(spark, sf):
    """Every page written as a WARC record, equal payloads as revisits, and all read back by byte ranges."""
    from tapewire.llm import warc

    files = warc.write_warc(warc.mark_revisits(table(spark, sf, "pages")))
    rows = warc.read_warc(files).select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        F.when(F.col("type") == "revisit", F.col("http_length")).otherwise(F.length("payload").cast("bigint")).alias("payload_bytes"),
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.page_number(F.col("refers_to_id")).alias("refers_to"),
    )
    return warc.checked(rows, files)


@query("op7_language_id")
def op7_language_id(spark, sf):
    """Language of every whole text, learned from labelled documents that are not held out."""
    from tapewire.llm.langid import fit_languages, held_out, predict_languages

    docs = table(spark, sf, "documents")
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))))
    judged = predict_languages(docs.select("doc_id", "text"), model, ["doc_id"])
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_vector_forest")
def op10_vector_forest(spark, sf):
    """All vectors of equal labels linked at a cosine of 0.98."""
    from tapewire.llm.near_dup import link_vectors

    return link_vectors(table(spark, sf, "embeddings"), threshold=0.98)


@query("op2_learned_partitions")
def op2_learned_partitions(spark, sf):
    """The 20 nearest rows of every 20th vector by inner product."""
    from tapewire.llm.learned_index import nearest

    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


WORD_SQL = r"[^\x20\x09-\x0D]+"
JACCARD_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_SQL}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
    ELSE list_distinct([hash(array_to_string(w[i:i + 4], ' ')) for i in range(1, len(w) - 3)]) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT p, q FROM pairs UNION ALL SELECT q, p FROM pairs),
reach(doc_id, other) AS (SELECT DISTINCT p, p FROM links UNION SELECT r.doc_id, l.q FROM reach r JOIN links l ON l.p = r.other),
parts AS (SELECT doc_id, min(other) AS part FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(part, doc_id) AS component_id FROM sets LEFT JOIN parts USING (doc_id)"""


@query("op6_jaccard_join", JACCARD_SQL)
def op6_jaccard_join(spark, sf):
    """Components of all documents linked at 80 % of their 5-word shingles."""
    from tapewire.llm.jaccard_join import jaccard_components

    found = jaccard_components(table(spark, sf, "documents"), percent=80)
    return found.select("doc_id", "n_shingles", "component_id")


def with_repeats(documents: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by crc32 of its id repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = documents.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD_SQL})"))).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    cut = words.select("doc_id", "text", "words", n.alias("n"), (g % F.greatest(n, F.lit(1))).cast("int").alias("a"), (3 + g % 8).alias("parts"))
    left = F.col("n") - F.col("a")
    cut = cut.withColumn("p", (1 + F.floor(left / F.col("parts"))).cast("int"))
    copies = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))
    tail = F.slice(F.flatten(copies), F.lit(1), left)
    repeated = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), tail)
    return cut.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf):
    """Runs of repeated word stretches in every document, and what is left when each is cut to one period."""
    from tapewire.llm.runs import periodic_runs

    found = periodic_runs(with_repeats(table(spark, sf, "documents").select("doc_id", "text")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_license_scan")
def op11_license_scan(spark, sf):
    """Base phrases and licence notices of every whole text by ordered signature rules."""
    from tapewire.llm.licenses import scan_licenses

    found = scan_licenses(table(spark, sf, "documents"))
    firsts = F.transform("base", lambda b: b["first"])
    named = {c: F.transform(c, lambda b: b["label"]) for c in ("base", "found")}

    def joined(labels):
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        joined(named["base"]).alias("base_labels"),
        joined(F.concat(named["base"], named["found"])).alias("labels"),
        "score",
    )


@query("op13_token_alignment")
def op13_token_alignment(spark, sf):
    """Ids of a byte-level and a piece vocabulary over the same bytes, with corpus-wide counts of linked pairs."""
    from tapewire.llm.alignment import align_tokenizers

    return align_tokenizers(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
