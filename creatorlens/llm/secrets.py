"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every whole text is searched for three base kinds (an assignment to a tell-tale name, an access key, a long
hexadecimal run) and for candidates: long mixed tokens that look live (letters and digits, many different
characters).  The hashes of all values, those of the base spans (of an assignment, what is assigned) and the
candidates, are counted over the corpus by distinct owner and repository.  A value that several owners hold is
a widely copied example (class ``copied``); one owner's is ``shared`` among several repositories or its ``own``.
Live-looking values of a single owner are added as spans of kind ``live``: candidates that no base span touches, and
values inside base spans (at the value's own place).  Values that several owners hold are not.

Places are code points, end exclusive.  Spark has no function for the places of all matches, so they come
from the lengths of the matches and of the gaps between them, summed up in two levels.

The counts are pre-aggregated per (hash, owner, repository) before each shuffle, so an example that a third of
all rows hold is one row per task; the counts meet its places in ``SALTS`` parts; spans travel, texts do not.  Null texts count as empty; a null owner or
repository counts as one of its own; rows with equal or null ids keep their own results.  Input columns other
than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creatorlens.llm.common import table, written

#: The kinds in their order and the patterns of the base kinds.
KINDS = ["assign", "access", "hex", "live"]
CLASSES = ["copied", "shared", "own"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # as AKIA[A-Z0-9]+ of 18 characters and more: a run is matched whole or fails
HEX = r"[0-9a-f]{16,}"  # as [0-9a-f]+ of 16 characters and more
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
VALUE_LEAST = 12
LIVE_LEAST = 20
DISTINCT_LEAST = 10
MARK = "[SECRET]"
SALTS = 8  # parts in which the places of one value meet its counts


def prefix_sums(sizes: Column) -> Column:
    """For each element the sum of those before it; n ** 1.5 steps by blocks of about sqrt(n)."""
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(sizes)))).cast("int")
    add = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    own = lambda b: F.slice(sizes, b * block + 1, block)
    sums = F.transform(F.sequence(F.lit(0), F.ceil(F.size(sizes) / block).cast("int")), lambda b: add(own(b)))
    bases = F.transform(sums, lambda _, b: add(F.slice(sums, F.lit(1), b)))
    return F.flatten(F.transform(bases, lambda base, b: F.transform(own(b), lambda _, i: base + add(F.slice(own(b), F.lit(1), i)))))


def located(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """Add ``out``: array of (start, end, value) of the pattern's leftmost non-overlapping matches."""
    values, gaps, steps, before = (f"__{out}_{x}" for x in ("values", "gaps", "steps", "before"))
    df = df.withColumn(values, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    found = F.size(values) > 0
    df = df.withColumn(gaps, F.when(found, F.transform(F.split(text, pattern, -1), F.length)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(steps, F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: g.cast("long") + F.length(v)))
    df = df.withColumn(before, F.when(found, prefix_sums(F.col(steps))).otherwise(F.array().cast("array<bigint>")))
    each = F.arrays_zip(F.col(values).alias("v"), F.col(before).alias("b"), F.slice(gaps, F.lit(1), F.size(values)).alias("g"))
    at = F.transform(each, lambda z: F.struct((z["b"] + z["g"]).alias("start"), (z["b"] + z["g"] + F.length(z["v"])).alias("end"), z["v"].alias("value")))
    return df.withColumn(out, at).drop(values, gaps, steps, before)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def scan_base(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base spans ``assign``, ``access``, ``hex`` (arrays of start, kind, end), their sorted union ``base``,
    ``values`` (start, kind, end, sha-256 of the value, whether it looks live; places of the values themselves) of the
    base spans and of the candidates that no base span touches, and ``held``: the different hashes of the base spans'
    values and of all candidates."""
    df = df.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("candidates", CANDIDATE)):
        df = located(df, "__text", pattern, name)
    value = F.regexp_extract_all("__text", F.lit(ASSIGN), F.lit(2))
    df = df.withColumn("__value", F.when(F.size("assign") > 0, value).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("assign", F.transform(F.filter(
        F.arrays_zip(F.col("assign").alias("s"), F.col("__value").alias("v")), lambda z: F.length(z["v"]) >= VALUE_LEAST),
        lambda z: F.struct(z["s"]["start"].alias("start"), z["s"]["end"].alias("end"), z["v"].alias("value"))))
    live = lambda v: (F.length(v) >= LIVE_LEAST) & v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(v, ""))) >= DISTINCT_LEAST)

    def valued(name: str):
        # an assignment ends with its value
        return lambda c: F.struct((c["end"] - F.length(c["value"])).alias("start"), F.lit(KINDS.index(name)).alias("kind"), c["end"].alias("end"),
                                  F.sha2(c["value"], 256).alias("hash"), live(c["value"]).alias("looks"))

    df = df.withColumn("__valued", F.concat(*[F.transform(kind, valued(kind)) for kind in KINDS[:3]]))
    for kind in KINDS[:3]:
        df = df.withColumn(kind, _kind(F.col(kind), kind))
    df = df.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    df = df.withColumn("__all", F.transform(F.filter("candidates", lambda c: live(c["value"])), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.sha2(c["value"], 256).alias("hash"), apart(c).alias("apart"))))
    bare = F.transform(F.filter("__all", lambda c: c["apart"]), lambda c: F.struct(
        c["start"].alias("start"), F.lit(KINDS.index("live")).alias("kind"), c["end"].alias("end"), c["hash"].alias("hash"), F.lit(True).alias("looks")))
    df = df.withColumn("values", F.array_sort(F.concat("__valued", bare)))
    hashes = lambda c: F.transform(c, lambda v: v["hash"])
    return df.withColumn("held", F.array_distinct(F.concat(hashes("__valued"), hashes("__all")))).drop("__text", "__value", "__valued", "__all", "candidates")


def ownership(scanned: DataFrame, owner: str, repository: str) -> DataFrame:
    """(hash, owners, repositories) of every value that the rows hold."""
    held = scanned.select(F.explode("held").alias("hash"),
                          F.struct(F.col(owner).alias("v")).alias("owner"), F.struct(F.col(repository).alias("v")).alias("repository"))
    each = held.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    return (each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
            .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))


def counted(scanned: DataFrame, id_col: str, counts: DataFrame, most_owners: int = 1) -> DataFrame:
    """(id, key, values): the values of each (id, key) with owners, repositories and class."""
    each = (scanned.filter(F.size("values") > 0).select(id_col, "key", F.explode("values").alias("v"))
            .select(id_col, "key", "v.start", "v.kind", "v.end", "v.hash", "v.looks").distinct()
            .withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")))
    counts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    kind = F.when(F.col("owners") > most_owners, CLASSES[0]).when(F.col("repositories") > F.col("owners"), CLASSES[1]).otherwise(CLASSES[2])
    value = F.struct("start", "kind", "end", "owners", "repositories", kind.alias("class"), "looks")
    return each.join(counts, ["hash", "salt"]).groupBy(id_col, "key").agg(F.array_sort(F.collect_list(value)).alias("values"))


def live_spans(values: str) -> Column:
    """The places of the live-looking values that are not copied."""
    kept = F.filter(values, lambda v: v["looks"] & (v["class"] != CLASSES[0]))
    spans = F.transform(kept, lambda v: F.struct(v["start"].alias("start"), F.lit(KINDS.index("live")).alias("kind"), v["end"].alias("end")))
    return F.coalesce(spans, F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))


def bare(values: str) -> Column:
    return F.filter(values, lambda v: v["kind"] == KINDS.index("live"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repository: Column | None = None) -> DataFrame:
    """(id, assign, access, hex, base, spans, key, values) of every row: arrays of (start, kind, end), sorted;
    ``values`` has owners, repositories and class of the base spans' and candidates' values, too.

    ``repository`` is the repository of a row; by default owner and language together.
    """
    repository = F.concat_ws("/", owner_col, "lang") if repository is None else repository
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.col(owner_col).alias("owner"), repository.alias("repository"))
    scanned = scan_base(rows).drop("text")
    scanned = scanned.withColumn("key", F.when(F.size("values") > 0, F.sha2(F.to_json("values"), 256)))
    scanned = written(scanned, "secret-spans")
    found = counted(scanned, id_col, ownership(scanned, "owner", "repository"))
    found = found.select(F.col(id_col).alias("__id"), F.col("key").alias("__key"), F.col("values").alias("__values"))
    none = F.array().cast(found.schema["__values"].dataType)
    return (scanned.join(found, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left")
            .select(id_col, "assign", "access", "hex", "base", F.array_sort(F.concat("base", live_spans("__values"))).alias("spans"), "key",
                    F.coalesce("__values", none).alias("values")))


def span_list(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    kind = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def value_list(values: str) -> Column:
    """kind:start:end:owners:repositories:class of every value counted, comma-joined."""
    kind = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.array_join(F.transform(values, lambda v: F.concat_ws(":", kind(v), v["start"], v["end"], v["owners"], v["repositories"], v["class"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """The documents with every span replaced by a mark (and ``n_chars`` made to fit).

    Only rows with candidates outside of base spans are joined with the corpus counts (of all rows' values); all
    others are done where they are scanned.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(owner_col).alias("owner"),
                       F.concat_ws("/", owner_col, "lang").alias("repository"))
    # written, or the filters below would repeat the whole scan inside their conditions
    scanned = scan_base(rows).withColumn("values", bare("values")).select("row", "id", "owner", "repository", "base", "values", "held")
    scanned = written(scanned.withColumn("key", F.when(F.size("values") > 0, F.sha2(F.to_json("values"), 256))), "secret-scan")
    scanned = scanned.withColumn("text", F.col(f"row.`{text_col}`"))
    alone = scanned.filter(F.col("key").isNull()).withColumn("spans", F.col("base"))
    held = scanned.filter(F.col("key").isNotNull())
    found = counted(held, "id", ownership(scanned, "owner", "repository"))
    found = found.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("values").alias("__values"))
    joined = (held.join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left")
              .withColumn("spans", F.array_sort(F.concat("base", live_spans("__values")))))
    both = alone.select("row", "text", "spans").unionByName(joined.select("row", "text", "spans"))
    # a piece runs from the furthest end before a span to its start
    ends = F.aggregate("spans", F.array(F.lit(0).cast("long")), lambda a, s: F.concat(a, F.array(F.greatest(F.element_at(a, -1), s["end"]))))
    both = both.withColumn("__from", F.when(F.size("spans") > 0, ends).otherwise(F.array(F.lit(0).cast("long"))))
    piece = lambda s, at: F.when(s["end"] <= at, F.lit("")).otherwise(F.concat(
        F.substr("text", (at + 1).cast("int"), F.greatest(s["start"] - at, F.lit(0)).cast("int")),
        F.when(s["start"] < at, F.lit("")).otherwise(F.lit(MARK))))
    pieces = F.zip_with("spans", F.slice("__from", F.lit(1), F.size("spans")), piece)
    text = F.concat(F.array_join(pieces, ""), F.substr("text", (F.element_at("__from", -1) + 1).cast("int")))
    out = both.withColumn("new", F.when(F.size("spans") > 0, text))
    changed = {text_col: F.coalesce("new", "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length("new").cast(docs.schema["n_chars"].dataType), F.col("row.n_chars"))
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"), value_list("values").alias("classes"))


_PLACES = """
SELECT row, {kind} AS kind, start, start + length(value) AS stop, value, v2 FROM (
  SELECT row, i, value, v2, CAST(coalesce(list_sum(list_transform(gaps[:i], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(vals[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start FROM (
    SELECT row, vals, string_split_regex(text, '{pattern}') AS gaps, unnest(vals) AS value, unnest(twos) AS v2,
           unnest(generate_series(1, len(vals))) AS i
    FROM (SELECT row, text, regexp_extract_all(text, '{pattern}') AS vals, regexp_extract_all(text, '{pattern}', {group}) AS twos FROM d)
    WHERE len(vals) > 0))
WHERE length(v2) >= {least}"""
_quoted = lambda p: p.replace("'", "''")

_LIVE = (f"length({{0}}) >= {LIVE_LEAST} AND regexp_matches({{0}}, '[0-9]') AND regexp_matches({{0}}, '[A-Za-z]') "
         f"AND len(list_distinct(string_split({{0}}, ''))) >= {DISTINCT_LEAST}")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, source, concat_ws('/', source, lang) AS repo FROM documents),
b AS ({_PLACES.format(kind=0, pattern=_quoted(ASSIGN), group=2, least=VALUE_LEAST)}
      UNION ALL {_PLACES.format(kind=1, pattern=ACCESS, group=0, least=0)}
      UNION ALL {_PLACES.format(kind=2, pattern=HEX, group=0, least=0)}),
c AS (SELECT p.*, EXISTS (SELECT 1 FROM b WHERE b.row = p.row AND b.start < p.stop AND p.start < b.stop) AS touched
      FROM ({_PLACES.format(kind=3, pattern=CANDIDATE, group=0, least=0)}) p WHERE {_LIVE.format('value')}),
v AS (SELECT row, kind, stop - length(v2) AS start, stop, v2 AS value, {_LIVE.format('v2')} AS looks FROM b
      UNION ALL SELECT row, kind, start, stop, value, true FROM c WHERE NOT touched),
o AS (SELECT value, count(DISTINCT coalesce('+' || source, '-')) AS owners, count(DISTINCT coalesce('+' || source, '-') || '|' || repo) AS repos
      FROM (SELECT row, v2 AS value FROM b UNION ALL SELECT row, value FROM c) JOIN d USING (row) GROUP BY value),
w AS (SELECT v.*, owners, repos, CASE WHEN owners > 1 THEN 'copied' WHEN repos > owners THEN 'shared' ELSE 'own' END AS class FROM v JOIN o USING (value)),
s AS (SELECT row, kind, start, stop FROM b UNION ALL SELECT row, 3, start, stop FROM w WHERE looks AND class <> 'copied'),
t AS (SELECT row, kind, start, stop, ['assign', 'access', 'hex', 'live'][kind + 1] || ':' || start || ':' || stop AS t FROM s),
g AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(t, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(t, ',' ORDER BY start, kind, stop) AS spans
      FROM t GROUP BY row),
k AS (SELECT row, string_agg(['assign', 'access', 'hex', 'live'][kind + 1] || ':' || start || ':' || stop || ':' || owners || ':' || repos || ':' || class, ','
             ORDER BY start, kind, stop) AS classes FROM w GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(classes, '') AS classes
FROM d LEFT JOIN g USING (row) LEFT JOIN k USING (row)
"""
