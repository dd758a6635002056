"""Category tree -> titles -> rule labels.

N1 walks JSON trees of any depth inside tasks: a document is one row, its nodes
leave in pre-order with their paths, and Spark's ``VARIANT`` functions read each
node's own fields.  No tree is walked on the driver, and documents are shuffled
only to be spread over the tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creatorlens import lexicons as L
from creatorlens.operators.lexicon import automaton, shippable, term_candidates
from creatorlens.operators.phrases import SALTS
from creatorlens.session import materialize

NODES = 4096  # nodes in one Arrow batch at most
PLACES = 1 << 18  # and places of their paths, which a chain of n levels has n * n / 2 of


def _no_constant(name: str):
    raise ValueError(name)  # JSON has no NaN or Infinity


def walk(navigation) -> Iterator[tuple[list[int], str]]:
    """(path, own fields as JSON) of the nodes below a list, in pre-order, with an explicit stack."""
    levels = [(iter(navigation), 0)] if isinstance(navigation, list) else []
    path: list[int] = []
    while levels:
        rest, at = levels[-1]
        node = next(rest, levels)
        if node is levels:
            levels.pop()
            path = path[:-1]
            continue
        levels[-1] = (rest, at + 1)
        here = [*path, at]
        fields = node if isinstance(node, dict) else {}
        content = fields.get("content")
        own = {"alias": fields.get("alias"), "title": content.get("title") if isinstance(content, dict) else None}
        yield here, json.dumps({k: v for k, v in own.items() if v is not None})
        below = fields.get("children")
        if isinstance(below, list) and below:
            path = here
            levels.append((iter(below), 0))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        ids = batch.column(0).take(pa.array([i] * len(paths), pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array(paths, pa.list_(pa.int32())), pa.array(range(first, first + len(paths)), pa.int32()),
                                           pa.array(own, pa.string())], names=["doc_id", "path", "pos", "own"])

    for batch in batches:
        for i, text in enumerate(batch.column(1)):
            try:
                tree = json.loads(text.as_py() or "null", parse_constant=_no_constant)
            except ValueError:  # not JSON: no nodes
                continue
            first, places, paths, own = 0, 0, [], []
            for path, fields in walk(tree.get("navigation") if isinstance(tree, dict) else None):
                paths.append(path)
                own.append(fields)
                places += len(path)
                if len(paths) >= NODES or places >= PLACES:
                    yield rows()
                    first, places, paths, own = first + len(paths), 0, [], []
            if paths:
                yield rows()


def flatten_tree(docs: DataFrame, *, with_position: bool = True) -> DataFrame:
    """Every node of every tree document.

    ``docs``: ``doc_id, json`` where json is ``{"navigation": [node...]}`` and a
    node is ``{"alias", "content": {"title"}, "children": [node...]}``; any part
    may be missing.  Output ``doc_id, path, depth, alias, title`` (+ ``pos``, the
    0-based pre-order position inside the document).  Nodes without a title are
    kept (their children are visited); filter with :func:`titled`.  Null and
    unreadable documents have no nodes; list elements that are no objects are nodes
    without alias and title.  The only bound on depth is the JSON reader's (about
    10,000 nested brackets, 5,000 levels): past it the job fails with its
    ``RecursionError`` rather than drop nodes.
    """
    docs = docs.select("doc_id", F.col("json").cast("string"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    nodes = docs.mapInArrow(_walked, f"doc_id {id_type}, path array<int>, pos int, own string")
    own = F.try_parse_json("own")
    return nodes.select("doc_id", "path", (F.size("path") - 1).alias("depth"),
                        F.try_variant_get(own, "$.alias", "string").alias("alias"),
                        F.try_variant_get(own, "$.title", "string").alias("title"), *(["pos"] if with_position else []))


def titled(nodes: DataFrame, col: str = "title") -> DataFrame:
    """Keep nodes whose title is present and non-empty (``if title:``)."""
    return nodes.where(F.col(col).isNotNull() & (F.col(col) != ""))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    while name.lower() in [c.lower() for c in df.columns]:
        name = f"_{name}"
    return name


def classify_title(title: Column, rules: Sequence[tuple[int, str, str]] | None = None,
                   default: str = L.DEFAULT_TITLE_CATEGORY) -> Column:
    """Category of the first rule group (by priority) with a keyword
    that occurs case-insensitively in the title; ``default`` otherwise.

    The rules are a bounded parameter list, compiled into one CASE expression
    (generated code, no join)."""
    rules = list(rules if rules is not None else L.title_rules())
    low = F.lower(title)
    groups: dict[tuple[int, str], list[str]] = {}
    for prio, cat, kw in sorted(rules, key=lambda r: r[0]):
        groups.setdefault((prio, cat), []).append(kw.lower())
    expr = None
    for (_, cat), kws in sorted(groups.items(), key=lambda kv: kv[0][0]):
        cond = None
        for kw in dict.fromkeys(kws):
            c = F.contains(low, F.lit(kw))
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def classify_titles(df: DataFrame, title_col: str = "title", rules=None,
                    default: str = L.DEFAULT_TITLE_CATEGORY) -> DataFrame:
    """N2 on a table: adds ``category``."""
    return df.withColumn("category", classify_title(F.col(title_col), rules, default))


def classify_titles_by_table(df: DataFrame, rules: DataFrame, title_col: str = "title", default: str = L.DEFAULT_TITLE_CATEGORY) -> DataFrame:
    """N2/J6 with the rules kept as a table ``(priority, category, keyword)`` of any size: adds ``category``.

    Among the keywords that occur in the title, case-insensitively, the least (priority, category) decides; ``default``
    if none does, also for null titles.  An empty keyword occurs in every title that isn't null; rules without keyword,
    priority or category never apply.  A table of checked size travels with the tasks as one automaton; a larger one
    meets the distinct titles by the keywords' grams (``lexicon.term_candidates``).  Both give the same."""
    rule = F.struct(F.col("priority").cast("int").alias("priority"), F.col("category").cast("string").alias("category"))
    best = rules.dropna(subset=["priority", "category", "keyword"]).select(F.lower("keyword").alias("term"), rule.alias("rule"))
    best = materialize(best.groupBy("term").agg(F.min("rule").alias("rule")))
    fields = [f for f in df.schema if f.name.lower() != "category"]
    if shippable(best):
        rows = sorted((r.rule.priority, r.rule.category, r.term) for r in best.collect())  # bounded by the check
        always = next((i for i, r in enumerate(rows) if not r[2]), len(rows))
        names = [r[1] for r in rows]
        low = free_name(df, "_low")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = [i for i, r in enumerate(rows) if r[2]]
            found = automaton([rows[i][2] for i in numbers])
            for batch in batches:
                out = []
                for title in batch.column(low).to_pylist():
                    held = found.iter(title) if numbers and title else ()
                    first = len(rows) if title is None else min([always, *(numbers[i] for _, i in held)])
                    out.append(names[first] if first < len(rows) else default)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(out, pa.string())], names=[*(f.name for f in fields), "category"])

        staged = df.select(*(F.col(f"`{f.name}`") for f in fields), F.lower(title_col).alias(low))
        return staged.mapInArrow(run, StructType([*fields, StructField("category", StringType())]))
    low, salt, row, part, title = (free_name(df, c) for c in ("_low", "_salt", "_row", "_part", "_title"))
    staged = df.select(*(F.col(f"`{f.name}`") for f in fields), F.lower(title_col).alias(low))
    staged = staged.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    titles = staged.where(F.col(low).isNotNull()).select(F.col(low).alias(title)).distinct()
    terms = best.where(F.length("term") > 0)
    met = term_candidates(titles, terms, title, title).where(F.contains(F.col(title), F.col("term"))).join(terms, "term")
    # a title that many rows repeat meets its rule in SALTS parts
    met = met.groupBy(title).agg(F.min("rule").alias(row)).withColumn(part, F.explode(F.array(*map(F.lit, range(SALTS)))))
    every = best.where(F.col("term") == "").agg(F.min("rule")).scalar()
    joined = staged.join(met, (F.col(low) == F.col(title)) & (F.col(salt) == F.col(part)), "left")
    chosen = F.when(F.col(low).isNotNull(), F.least(F.col(row), every))
    return joined.select(*(F.col(f"`{f.name}`") for f in fields), F.coalesce(chosen["category"], F.lit(default)).alias("category"))


def exclude_titles(df: DataFrame, title_col: str = "title",
                   exclusions: Sequence[str] = L.IRRELEVANT_TITLES) -> DataFrame:
    """Drop rows whose title is on the exclusion list (exact match;
    the optimizer turns the literal list into a hash set)."""
    return df.where(~F.col(title_col).isin(list(dict.fromkeys(exclusions))) | F.col(title_col).isNull())


def rules_from_table(rules: DataFrame) -> list[tuple[int, str, str]]:
    """J6 with the rules kept as a table ``(priority, category, keyword)``.

    A rule table is configuration, not data: it is compiled into the CASE
    expression of :func:`classify_title`, which avoids a nested-loop
    ``contains`` join."""
    return [(int(r["priority"]), r["category"], r["keyword"]) for r in rules.select("priority", "category", "keyword").collect()]
