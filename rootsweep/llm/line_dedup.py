"""Operator 10: fuzzy line deduplication by MinHash, in DataFrame operations only.

A line (trimmed, lower-cased) has the set of its character shingles: the ``SHINGLE``
characters from each of its characters on, spaces included, in every script alike (a
line that is shorter is one shingle).
Its signature is the ``KEEP``
smallest hashes (shingles are hashed as rows, of which only those are gathered by line that
are below a bound that about ``NEAR_KEEP`` of them stay under; lines where too few different
ones do are hashed again and sorted whole); every three neighbours among them are a band, so two lines meet if
three common shingles follow each other in the order of hashes. For lines of up to 8
shingles every two neighbours are a band (of 7 and 8: both), as few would be left. In
each band every line is paired with the smallest line and with the one before it. Pairs
are verified by the exact Jaccard similarity of their sets (>= ``percent`` %); pairs whose
marks (parity bits of their shingles) prove them below it are left out before. Connected
components are found by rounds of joins. In bands of up to ``PAIRED`` lines these were all
pairs. Larger ones whose lines are then in several components go on by blocks: the lines of
a band are dealt to blocks of about ``BLOCK``, and a row per two blocks compares all
lines of the one with all of the other (a pair that shares several bands in the smallest
of them), with a set, made once, for each line that the marks leave in a pair, so that in the end every two lines that share a band are verified or connected. Of each component the first line
(smallest id, then place) stays.

Scale: equal lines are merged first; bands have a line once; no group is ever
collected. Pairs per band are linear in its lines; in the second round the rows are pairs of
blocks, the comparisons within them the square of the lines that are alike in a band and
yet below ``percent``, and only links come out. The bands that several lines have, and
the lines that a verification needs, are found by semi joins, which broadcast up to
``MAX_KEYS`` keys and shuffle beyond.

Cases: a null text has no line and stays null; blank lines are kept and never compared;
lines of any length are compared whole; repeated rows (same id and text) count as one
document; a null id sorts first; an empty table gives an empty result; other columns
are carried along. Lines are told apart by a 64-bit hash of text and length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootsweep.llm.common import components, stored

SHINGLE = 8
KEEP = 10
PERCENT = 75
MAX_KEYS = 1_000_000
#: About so many hashes of a line are sorted to find its smallest: of lines with as many
#: different shingles as places, no more than 10 of 24 in 1 of 900.
NEAR_KEEP = 24
#: In a band of up to so many lines the smallest and the line before make every pair.
PAIRED = 3
#: What is left in larger bands is compared by blocks of so many lines.
BLOCK = 128
#: 64-bit words of a line's marks (a power of two): 1,024 bits.
MARKS = 16
#: Hashes of the shingles of a whole line. Four bytes a character let each be cut out
#: without a walk through the line; the outer transform binds these bytes to a name.
_SHINGLES = ("transform(array(encode(line, 'UTF-32')), b -> transform(sequence(1, greatest(octet_length(b) - 4 * {0} + 1, 1), 4), "
             "i -> xxhash64(substring(b, i, 4 * {0}))))[0]")
_PAIRS = "transform(sequence(0, size(low) - 2), i -> xxhash64(low[i], low[i + 1]))"
_TRIPLES = "transform(sequence(0, size(low) - 3), i -> xxhash64(low[i], low[i + 1], low[i + 2]))"
#: The same as ``_TRIPLES`` for ``KEEP`` hashes, without a lambda.
_FULL = f"array({', '.join(f'xxhash64(low[{i}], low[{i + 1}], low[{i + 2}])' for i in range(KEEP - 2))})"
_BANDS = f"case when size(low) = {KEEP} then {_FULL} when size(low) = 1 then low when size(low) < 7 then {_PAIRS} when size(low) < 9 then concat({_PAIRS}, {_TRIPLES}) else {_TRIPLES} end"


def _split(src: DataFrame, *names: str) -> DataFrame:
    """The named columns of ``src`` for each non-blank line of its ``text``, with (no, line, key)."""
    rows = src.select(*names, F.posexplode(F.split(F.lower("text"), "\n")).alias("no", "raw")).where("trim(raw) <> ''")
    return rows.select(*names, "no", F.trim("raw").alias("line")).withColumn("key", F.xxhash64("line", F.octet_length("line")))


def _with_shingles(lines: DataFrame, width: int) -> DataFrame:
    """Adds ``set``: the distinct hashed shingles of ``line``, ascending."""
    return lines.withColumn("set", F.sort_array(F.array_distinct(F.expr(_SHINGLES.format(width)))))


def _lowest(hashes: str, keep: int) -> str:
    """The ``keep`` smallest distinct ``hashes``, ascending."""
    return f"slice(sort_array(array_distinct({hashes})), 1, {keep})"


def _signed(docs: DataFrame, width: int, keep: int, id_col: str, text_col: str) -> DataFrame:
    """(key, id, th, no, bands) of every line; ``th`` is the hash of the text. Shingles are
    hashed as rows (the hashes of ``_SHINGLES``), and gathered by line where their document
    is, without a shuffle. A line's first shingle stays even if above the bound."""
    near = max(NEAR_KEEP, 2 * keep + 4)
    bound = f"cast(-9.223372036854775E18D + 1.844674407370955E19D * ({near}.0D / n) as bigint)"
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    src = src.withColumn("th", F.xxhash64("text"))
    once = src.groupBy("id", "th").agg(F.first("text").alias("text"))
    lines = _split(once, "id", "th").withColumn("b", F.encode("line", "UTF-32")).drop("line")
    lines = lines.withColumn("n", F.expr(f"greatest(octet_length(b) div 4 - {width - 1}, 1)")).withColumn("whole", F.expr(f"n <= {near}"))
    names = ["id", "th", "no", "key", "whole"]
    rows = lines.select(*names, "b", F.expr(f"case when not whole then {bound} end").alias("most"), F.explode(F.expr("sequence(1, cast(4 * n as int), 4)")).alias("i"))
    rows = rows.select(*names, "most", "i", F.expr(f"xxhash64(substring(b, i, 4 * {width}))").alias("h")).where("whole or h <= most or i = 1")
    low = rows.groupBy(*names).agg(F.collect_list("h").alias("h")).withColumn("low", F.expr(_lowest("h", keep + 1)))
    low = low.withColumn("low", F.expr(f"case when whole or size(low) > {keep} then slice(low, 1, {keep}) end"))
    sign = stored(low.select("key", "id", "th", "no", F.expr(f"case when low is not null then {_BANDS} end").alias("bands")), "lines")
    few = stored(sign.where("bands is null").select("key", "th").distinct(), "lines")
    if few.isEmpty():
        return sign
    again = _among(src.select("th", "text"), few.select("th").distinct(), "th")
    again = _among(_split(again, "th"), few.select("key").distinct(), "key").groupBy("key").agg(F.min("line").alias("line"))
    again = stored(again.select("key", F.expr(_lowest(_SHINGLES.format(width), keep)).alias("low")).select(
        "key", F.expr(_BANDS).alias("bands")), "lines")
    return sign.where("bands is not null").unionByName(sign.where("bands is null").drop("bands").join(again, "key"))


def _marked(texts: DataFrame, width: int) -> DataFrame:
    """(key, size, marks) of lines (key, line): how many different shingles a line has, and
    bits, each set if an odd number of them falls on it. So two lines' marks differ in no
    more bits than there are shingles that only one of the two has."""
    rows = texts.select("key", F.explode(F.array_distinct(F.expr(_SHINGLES.format(width)))).alias("h"))
    bit = "case when (shiftright(h, 6) & {1}) = {0} then shiftleft(1L, cast(h & 63 as int)) else 0L end"
    words = [F.bit_xor(F.expr(bit.format(i, MARKS - 1))) for i in range(MARKS)]
    return rows.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("size"), F.array(*words).alias("marks"))


def _may_reach(percent: int, a: str, b: str) -> str:
    """False only for lines ``a`` and ``b`` (prefixes of size and marks) below ``percent``."""
    return (f"least({a}size, {b}size) * 100 >= greatest({a}size, {b}size) * {percent} and aggregate(zip_with({a}marks, {b}marks, "
            f"(u, v) -> bit_count(u ^ v)), 0, (s, u) -> s + u) * {100 + percent} <= ({a}size + {b}size) * {100 - percent}")


def _similar(pairs: DataFrame, texts: DataFrame, marks: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of lines that reach ``percent``. The lines are moved, not their
    sets, which are eight times as large, and only for pairs that the marks leave open."""
    for side in ("a", "b"):
        pairs = pairs.join(marks.toDF(side, f"{side}_size", f"{side}_marks"), side)
    able = pairs.where(_may_reach(percent, "a_", "b_")).select("a", "b", (F.col("a_size") + F.col("b_size")).alias("sizes"))
    both = able.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")
    hashes = [_SHINGLES.format(width).replace("line", side) for side in ("x", "y")]
    # inline keeps the hashes from being made again for the condition
    both = both.select("a", "b", "sizes", F.expr(f"inline(array(struct({hashes[0]} as p, {hashes[1]} as q)))"))
    return both.where(f"size(array_intersect(p, q)) * {100 + percent} >= sizes * {percent}").select("a", "b")


#: Lines of two blocks (p.l and p.r, of a block with itself the same) that are similar and in different components, each
#: pair in the smallest band that both have: first the places (m, n) of those that the marks leave open, then the sets of
#: lines in such pairs, then the comparison of these.
_BLOCK_OPEN = """transform(array(transform(r, (b, n) -> struct(b, n))), y -> flatten(transform(l, (a, m) -> transform(filter(y, x ->
    a.component <> x.b.component and (i < j or a.key < x.b.key) and array_min(array_intersect(a.bands, x.b.bands)) = band
    and {may_reach}), x -> struct(m, x.n as n)))))[0]"""
_BLOCK_SET = "transform({0}, (x, k) -> case when {1} then array_distinct({2}) end)"
_BLOCK_LINKS = """transform(filter(array({open}), o -> size(o) > 0), o -> transform(array(struct({left} as ls, {right} as rs)), s ->
    transform(filter(o, x -> size(array_intersect(s.ls[x.m], s.rs[x.n])) * (100 + {percent}) >= (l[x.m].size + r[x.n].size) * {percent}),
    x -> struct(least(l[x.m].key, r[x.n].key) as a, greatest(l[x.m].key, r[x.n].key) as b, l[x.m].component as c, r[x.n].component as d)))[0])"""


def _by_blocks(left: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) among the lines (band, key, component) of each band."""
    return _block_links(left, texts, _marked(texts, width), percent, width).select("a", "b")


def _block_links(left: DataFrame, texts: DataFrame, marks: DataFrame, percent: int, width: int) -> DataFrame:
    """The same with the components (c, d) that each links."""
    bands = left.groupBy("key").agg(F.collect_set("band").alias("bands"))  # at most a line's own bands
    many = left.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    lines = left.select("band", "key", "component").join(bands.join(texts, "key").join(marks, "key"), "key").join(many, "band")
    blocks = stored(lines.select("band", "blocks", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("i"),
                                 F.struct("key", "component", "bands", "size", "marks", "line").alias("x"))
                    .groupBy("band", "blocks", "i").agg(F.collect_list("x").alias("l")), "lines")
    pairs = blocks.withColumn("j", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1))).join(
        blocks.select("band", F.col("i").alias("j"), F.col("l").alias("r")), ["band", "j"])
    sets = [_BLOCK_SET.format(side, f"array_contains(o.{place}, k)", _SHINGLES.format(width).replace("line", "x.line")) for side, place in (("l", "m"), ("r", "n"))]
    links = _BLOCK_LINKS.format(open=_BLOCK_OPEN.format(may_reach=_may_reach(percent, "a.", "x.b.")), left=sets[0], right=sets[1], percent=percent)
    return pairs.select(F.expr(f"inline(flatten({links}))")).distinct()


def _among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is in the stored ``keys``."""
    return rows.join(F.broadcast(keys) if keys.count() <= MAX_KEYS else keys, column, "left_semi")


def line_components(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, keep: int = KEEP,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every line (key, id, th, no), and the component of every distinct line with links
    (node, component)."""
    sign = _signed(docs, width, keep, id_col, text_col)
    bands = sign.select("key", F.explode("bands").alias("band"))
    several = stored(bands.groupBy("band").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("band"), "lines")
    shared = stored(_among(bands, several, "band").distinct(), "lines")  # bands of several lines
    w = Window.partitionBy("band").orderBy("key")
    near = shared.select("band", F.col("key").alias("b"), F.lag("key").over(w).alias("before"), F.first("key").over(w).alias("smallest"))
    pairs = near.where("before is not null").select(F.explode(F.array_distinct(F.array("before", "smallest"))).alias("a"), "b")

    keys = stored(shared.select("key").distinct(), "lines")
    wanted = _among(_split(docs.select(F.col(f"`{text_col}`").alias("text"))).select("key", "line"), keys, "key")
    texts = stored(wanted.groupBy("key").agg(F.min("line").alias("line")), "lines")
    return sign.select("key", "id", "th", "no"), _linked(shared, pairs, texts, percent, width)


def _linked(shared: DataFrame, pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Components after every two lines of a band are verified or already connected: first
    ``pairs``, then by blocks what is left of bands that have lines besides these."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "lines")
    marks = stored(_marked(texts, width), "lines")
    label = components(_similar(pairs, texts, marks, percent, width))
    named = shared.join(label, F.col("key") == F.col("node"), "left").select(
        "band", "key", F.coalesce("component", "key").alias("component"))
    several = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                        F.count(F.lit(1)).alias("n")).where(f"lo <> hi and n > {PAIRED}")
    left = stored(named.join(several.select("band"), "band", "left_semi"), "lines")
    rest = stored(_block_links(left, texts, marks, percent, width), "lines")
    if rest.isEmpty():
        return label
    # components of components: few, so their rounds are short
    joined = components(rest.select("c", "d")).toDF("was", "now")
    nodes = label.unionAll(rest.select(F.explode(F.array("c", "d")).alias("node"), F.col("node").alias("component"))).distinct()
    return nodes.join(joined, F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("now", "component").alias("component")).where("node <> component")


def removed_lines(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, keep: int = KEEP,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, nos): places of the lines of each document that are not the first of their component."""
    lines, label = line_components(docs, percent, width, keep, id_col, text_col)
    label = label.unionAll(label.select(F.col("component").alias("node"), "component")).distinct()  # the smallest too
    many = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(
        label, F.col("key") == F.col("node"), "left").where("n > 1 or component is not null").select(
        "key", F.coalesce("component", "key").alias("component"))
    group = stored(lines.join(many, "key").drop("key"), "lines")  # lines that have another like them
    first = group.groupBy("component").agg(F.min(F.struct("id", "th", "no")).alias("keep"))
    gone = group.join(first, "component").where(~F.struct("id", "th", "no").eqNullSafe(F.col("keep")))
    return gone.groupBy("id", "th").agg(F.collect_set("no").alias("nos"))  # at most a document's own lines


def dedup_lines(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, keep: int = KEEP,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the repeated lines taken out of the text, and
    n_lines (non-blank lines before), n_removed."""
    gone = stored(removed_lines(docs, percent, width, keep, id_col, text_col), "lines")
    gone = gone.toDF("__id", "__th", "__nos")
    names = docs.columns
    src = docs.withColumn("__h", F.xxhash64(F.col(f"`{text_col}`")))
    out = src.join(gone, src[f"`{id_col}`"].eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left")
    text = F.col(f"`{text_col}`")
    out = out.withColumn("__lines", F.split(text, "\n"))
    blank = F.coalesce(F.size(F.filter("__lines", lambda x: F.trim(x) != "")), F.lit(0))
    kept = F.when(F.col("__nos").isNull(), text).otherwise(F.array_join(F.filter(
        "__lines", lambda x, i: ~F.array_contains("__nos", i)), "\n"))
    return out.select(*[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in names],
                      F.when(text.isNull(), 0).otherwise(blank).cast("bigint").alias("n_lines"),
                      F.coalesce(F.size("__nos"), F.lit(0)).cast("bigint").alias("n_removed"))
