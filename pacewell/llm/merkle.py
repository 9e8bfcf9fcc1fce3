"""Document fingerprints: Merkle trees over words, paragraphs and sections, as text.

Paragraphs are lines; a paragraph's leaves are its runs of LEAF_WORDS words. A
leaf's hash is over its words, a paragraph's over its leaves' hashes, a
section's over its paragraphs', the root's over the sections'. The tree is
written as

    root|section:paragraph=leaf,leaf;paragraph=leaf|section:paragraph=...

Inner hashes are whole, so equal roots mean equal texts; the written leaves
are cut short, since they only serve to compare. A section ends after a
paragraph whose hash says so, one in eight: sections are cut by what they
hold, so an inserted line changes its own section and leaves those after it.
Leaves are fixed runs, so an inserted word also changes the leaves after it,
up to the end of its paragraph. All of it is column expressions, and each
looks at a text once, whatever its number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pacewell.llm import common

LEAF_WORDS = 6
LEAF_DIGITS = 8
NODE_DIGITS = 32
CUTS = ("0", "8")
PARTS = 64


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _paragraph(line: Column) -> Column:
    """Hash and leaves of a paragraph, and what parts it from the next one; the break after a run of words belongs to it."""
    marked = F.regexp_replace(line, rf"((?:[^ ]* ){{{LEAF_WORDS}}})", "$1\u0001")
    hashes = F.transform(F.split(marked, "\u0001", -1), lambda run: F.md5(run.cast("binary")))

    def written(leaves: Column) -> Column:
        short = F.array_join(F.transform(leaves, lambda h: F.left(h, F.lit(LEAF_DIGITS))), ",")
        return _let(F.md5(F.array_join(leaves, ",").cast("binary")), lambda node: F.concat(
            node, F.lit("="), short, F.when(F.left(node, F.lit(1)).isin(*CUTS), "|").otherwise(";")))

    return _let(hashes, written)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty. Texts that differ have different roots, up to MD5."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    written = F.regexp_replace(F.array_join(F.transform(lines, _paragraph), ""), "[|;]$", "")
    sections = F.transform(F.split(written, r"\|", -1), lambda s: F.concat(F.md5(s.cast("binary")), F.lit(":"), s))

    def rooted(parts: Column) -> Column:
        nodes = F.array_join(F.transform(parts, lambda s: F.left(s, F.lit(NODE_DIGITS))), ",")
        return F.concat(F.sha2(nodes.cast("binary"), 256), F.lit("|"), F.array_join(parts, "|"))

    return _let(sections, rooted)


def sections(print_: Column) -> Column:
    """The sections of a fingerprint in order, each with its hash, paragraphs and leaves."""
    return F.slice(F.split(print_, r"\|", -1), 2, F.lit(1 << 30))


def leaves(print_: Column) -> Column:
    """All leaf hashes of a fingerprint, in order."""
    bare = F.regexp_replace(F.regexp_replace(print_, r"^[0-9a-f]*\|", ""), rf"[0-9a-f]{{{NODE_DIGITS}}}[:=]", "")
    return F.split(bare, r"[|;,]", -1)


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct leaves in common, of the fingerprint that has more; 1 for equal roots."""
    both = F.array(F.array_distinct(leaves(a)), F.array_distinct(leaves(b)))

    def shared(xy: Column) -> Column:
        x, y = F.get(xy, 0), F.get(xy, 1)
        return F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)).cast("double")

    return F.when(F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1), F.lit(1.0)).otherwise(_let(both, shared))


def changed_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of ``b`` that ``a`` does not have; the other way round, those that are gone."""

    def new(known: Column) -> Column:
        numbered = F.transform(sections(b), lambda s, i: F.when(F.array_contains(known, s), F.lit(None)).otherwise(i))
        return F.filter(numbered, lambda i: i.isNotNull())

    return _let(sections(a), new)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; other columns are not read."""
    return docs.select("doc_id", fingerprint(F.col("text").cast("string")).alias("fingerprint"))


def _ranges(keys: DataFrame, parts: int) -> list[tuple[int, int]]:
    """Smallest and largest key of ranges of about equal size; at most ``parts`` pairs reach the driver."""
    ranged = keys.repartitionByRange(parts, "key").groupBy(F.spark_partition_id().alias("p"))
    return sorted((r["least"], r["most"]) for r in ranged.agg(F.min("key").alias("least"), F.max("key").alias("most")).collect())


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range that a key lies in: a coarse and a fine count, so about 2 sqrt(n) comparisons."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse, fine = bounds[step::step], [bounds[i : i + step] for i in range(0, len(bounds), step)]
    at = sum((F.when(key >= b, 1).otherwise(0) for b in coarse), F.lit(0))
    own = F.element_at(F.array(*[F.array(*[F.lit(b) for b in part]) for part in fine]), at + 1)
    return at * step + F.size(F.filter(own, lambda b: b <= key))


def with_next(docs: DataFrame, parts: int | None = None, made=None) -> DataFrame:
    """(doc_id, text, next_text): the text of the next row in ascending doc_id; after the last comes the first.

    With ``made``, a function of the text, also what it gives for the text and
    for the next one (made, next_made), which is computed once for each row.

    Null ids come first, equal ids follow by the hash of their text, and null
    texts are empty. Rows are dealt by ranges of doc_id, in which a window
    finds the next one; the first and the last row of each range, one a range,
    are read once more and put together.
    """
    spark = docs.sparkSession
    parts = parts or max(PARTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    least = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    made = made or (lambda text: F.lit(""))
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.lit(least)), "made": made(F.col("text"))})
    ranges = _ranges(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key")), parts)
    if not ranges:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"), "made", F.col("made").alias("next_made"))
    bounds = [r[0] for r in ranges]
    order = Window.partitionBy("range").orderBy("key", F.xxhash64("text"))
    ranged = rows.withColumn("range", _range_of(F.col("key"), bounds))
    inner = ranged.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", "made")}).where("next_text IS NOT NULL")

    def ends(keys: list[int], choose) -> DataFrame:
        own = F.col("doc_id").isin([k for k in keys if k != least])
        own = own | F.col("doc_id").isNull() | (F.col("doc_id") == least) if least in keys else own
        return rows.where(own).groupBy("key").agg(choose(F.struct("doc_id", "text", "made"), F.xxhash64("text")).alias("end"))

    last = ends([r[1] for r in ranges], F.max_by).select(_range_of(F.col("key"), bounds).alias("range"), "end.doc_id", "end.text", "end.made")
    # The first row of a range follows the last one of the range before, that of the first range the last of all.
    before = F.pmod(_range_of(F.col("key"), bounds) - 2, F.lit(len(bounds))) + 1
    first = ends(bounds, F.min_by).select(before.alias("range"), F.col("end.text").alias("next_text"), F.col("end.made").alias("next_made"))
    columns = "doc_id", "text", "next_text", "made", "next_made"
    return inner.select(*columns).unionByName(last.join(first, "range").select(*columns))


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many of the next text's first."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.left(text, F.length(text) - quarter), F.left(following, quarter))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_next(common.table(spark, sf_dir, "documents"), made=fingerprint)
    rows = docs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.col("made").alias("fingerprint"), "next_made",
        edited(F.col("text"), F.col("next_text")).alias("edited"))
    rows = rows.select(
        "doc_id", "n_chars", "fingerprint", "next_made", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"))
    near_edited, near_next = (likeness(F.col("fingerprint"), F.col(c)) for c in ("edited_fingerprint", "next_made"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near_edited.alias("near_edited"), near_next.alias("near_next"))


def _sql_fingerprint(text: str) -> str:
    runs = f"string_split(regexp_replace(line, '((?:[^ ]* ){{{LEAF_WORDS}}})', '\\1' || chr(1), 'g'), chr(1))"
    node = f"md5(array_to_string(list_transform({runs}, lambda run: md5(run)), ','))"
    short = f"array_to_string(list_transform({runs}, lambda run: left(md5(run), {LEAF_DIGITS})), ',')"
    end = f"CASE WHEN left({node}, 1) IN {CUTS} THEN '|' ELSE ';' END"
    written = f"array_to_string(list_transform(string_split({text}, chr(10)), lambda line: {node} || '=' || {short} || {end}), '')"
    parts = f"list_transform(string_split(left({written}, -1), '|'), lambda s: md5(s) || ':' || s)"
    nodes = f"array_to_string(list_transform({parts}, lambda s: left(s, {NODE_DIGITS})), ',')"
    return f"sha256({nodes}) || '|' || array_to_string({parts}, '|')"


def _sql_likeness(a: str, b: str) -> str:
    bare = f"list_distinct(string_split_regex(regexp_replace(regexp_replace({{0}}, '^[0-9a-f]*\\|', ''), '[0-9a-f]{{{{{NODE_DIGITS}}}}}[:=]', '', 'g'), '[|;,]'))"
    x, y = bare.format(a), bare.format(b)
    return f"CASE WHEN split_part({a}, '|', 1) = split_part({b}, '|', 1) THEN 1.0::DOUBLE ELSE len(list_intersect({x}, {y})) / greatest(len({x}), len({y}))::DOUBLE END"


OP9_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
linked AS (
  SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM docs
),
edits AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(following, length(text) // 4) AS edited FROM linked
),
prints AS (
  SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
    {_sql_fingerprint("text")} AS fingerprint, {_sql_fingerprint("edited")} AS edited_fingerprint, {_sql_fingerprint("following")} AS next_fingerprint
  FROM edits
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {_sql_likeness("fingerprint", "edited_fingerprint")} AS near_edited, {_sql_likeness("fingerprint", "next_fingerprint")} AS near_next
FROM prints
"""
