"""Secret scanning with multipart credential linking, on DataFrame functions alone.

Base patterns are reported wherever they match. Parts that mean little alone, such
as a login name, a bare 40-character key or an endpoint, are candidates: they are
reported only when complementary parts lie within the scope around them. Spans of
a document are ordered once and each candidate meets the nearest part of every
other role before and behind it, so no pair of spans is ever formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.llm.common import stage

# The base patterns, with the group that is measured and its least length.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # The same matches as AKIA[A-Z0-9]+ of 20 and [0-9a-f]+ of 24 characters: a run's first match is its longest.
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
# Candidates: pattern, and the roles of which one each must lie within the scope.
WEAK = {
    "login": (r"""(?i:user(?:name)?|login|client_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", (("assign",),)),
    "key40": (r"(?<![A-Za-z0-9+/=])(?![0-9a-f]{40})[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", (("access",),)),
    "endpoint": (
        r"""https?://[^\x20\x09-\x0D"'<>]+""",
        (("access", "login"), ("assign", "key40")),
    ),
}
SCOPE = 256  # code points between a candidate and its complement
KINDS = [*BASE, *WEAK]
PATTERNS = {**{k: v[0] for k, v in BASE.items()}, **{k: v[0] for k, v in WEAK.items()}}


def _matches(text: Column, kind: str) -> Column:
    """(kind, place, length of the text since the last match, length, measured length) per match.

    Lengths of the texts between matches, of which there is one more, give the
    positions; every array is made once per row and zipped.
    """
    pattern = F.lit(PATTERNS[kind])
    lengths = lambda texts: F.transform(texts, F.length)
    whole = lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
    between = lengths(F.split(text, PATTERNS[kind], -1))
    group = BASE[kind][1] if kind in BASE else 0
    measured = lengths(F.regexp_extract_all(text, pattern, F.lit(group))) if group else whole
    zipped = F.arrays_zip(between, whole, measured).cast("array<struct<gap:int,length:int,measured:int>>")
    rows = F.transform(
        F.filter(zipped, lambda z: z["length"].isNotNull()),
        lambda z, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("at"), z["gap"], z["length"], z["measured"]),
    )
    return F.when(text.rlike(PATTERNS[kind]), rows)


def find_spans(documents: DataFrame, keep: list[str], scope: int = SCOPE) -> DataFrame:
    """Columns `keep`, `spans` and `base`: arrays of (start, kind, end) in code points, end exclusive.

    `base` holds assign, access and hex; `spans` also the linked candidates. Both
    are sorted by start, then by the order of KINDS. Null and empty texts have
    empty arrays; repeated rows are scanned one by one. A kind's matches are the
    leftmost ones that do not overlap; too short ones are dropped after matching.
    A candidate never counts as its own complement.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    found = F.flatten(F.array_compact(F.array(*[_matches(text, k) for k in KINDS])))
    # The id is given before a row is exploded, so that it stays one per row.
    marked = documents.select(F.monotonically_increasing_id().alias("uid"), row.alias("row"), found.alias("found"))
    marked = marked.select("uid", "row", F.explode_outer("found").alias("m")).select("uid", "row", "m.*")
    by_kind = Window.partitionBy("uid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(by_kind)
    placed = marked.repartition("uid").withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    long_enough = F.col("measured") >= F.get(F.array(*[F.lit(BASE[k][2] if k in BASE else 0) for k in KINDS]), F.col("kind"))
    placed = placed.where(F.col("kind").isNull() | long_enough)
    before = Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)

    def near(role: str) -> Column:
        mine = F.col("kind") == KINDS.index(role)
        ends, starts = F.max(F.when(mine, F.col("end"))).over(before), F.min(F.when(mine, F.col("start"))).over(behind)
        return F.coalesce(F.col("start") - ends <= scope, F.lit(False)) | F.coalesce(
            starts - F.col("end") <= scope, F.lit(False)
        )

    roles = sorted({r for _, needs in WEAK.values() for need in needs for r in need})
    placed = placed.withColumns({f"near_{r}": near(r) for r in roles})
    holds = F.col("kind") < len(BASE)
    for kind, (_, needs) in WEAK.items():
        complete = F.lit(True)
        for need in needs:
            any_of = F.lit(False)
            for role in need:
                any_of = any_of | F.col(f"near_{role}")
            complete = complete & any_of
        holds = holds | ((F.col("kind") == KINDS.index(kind)) & complete)
    span = F.struct("start", "kind", "end")
    spans = placed.groupBy("uid").agg(
        F.first("row").alias("row"),
        F.array_sort(F.collect_list(F.when(F.col("kind") < len(BASE), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(holds, span))).alias("spans"),
    )
    return spans.select(*[F.col(f"row.`{c}`") for c in keep], "base", "spans")


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def mask_spans(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with every span replaced by `mark`; overlapping and touching spans become one."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    step = lambda acc, s: F.struct(
        F.when(s["end"] <= acc["at"], acc["out"])
        .when((s["start"] <= acc["at"]) & (acc["at"] > 0), acc["out"])
        .otherwise(
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        )
        .alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"),
    )
    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, rest)).otherwise(text)


def mask_secrets(documents: DataFrame) -> DataFrame:
    """`documents` with every reported span masked in text, and n_chars, where present, of the new text.

    Spans travel without texts and come back to their rows by id and a digest of the
    text; documents without spans are unchanged.
    """
    own = documents.columns
    keyed = documents.withColumn("_text_hash", F.xxhash64("text"))
    found = find_spans(keyed.select("doc_id", "text", "_text_hash"), ["doc_id", "_text_hash"]).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("_of"), F.col("_text_hash").alias("_found_hash"), F.col("spans").alias("_spans"))
    found = stage(found.dropDuplicates(["_of", "_found_hash"]), "spans")
    met = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("_text_hash") == F.col("_found_hash")), "left")
    masked = F.when(F.col("_spans").isNotNull(), mask_spans(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    met = met.withColumn("_masked", masked)
    length = F.length("_masked").cast("bigint")
    made = {"text": F.col("_masked"), "n_chars": F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(length) if "n_chars" in own else None}
    return met.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in own])
