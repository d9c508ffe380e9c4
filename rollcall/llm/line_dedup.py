"""Fuzzy deduplication of lines by MinHash, in DataFrame functions only.

Every line gets a signature of its character n-grams; lines that agree in a
band of it are candidates, compared by their exact Jaccard similarity; similar
lines are joined by distributed union-find, and of each component one line
stays.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import components
from rollcall.operators.skew import split_left_join
from rollcall.session import passing, remove, staged


@dataclass(frozen=True)
class Settings:
    """Values come in groups; a band is any ``width`` - 1 values of one group.

    Each value of a pair agrees with its similarity t, so that a group of four
    has a band in common unless two or more differ: at t = 0.8 all three groups
    fail for 6 pairs of 1,000.
    """

    gram: int = 8
    threshold: float = 0.8
    groups: int = 3
    width: int = 4
    # Of all values so many may differ before a pair is compared; at the threshold more do in five
    # pairs of ten thousand.
    most_unlike: int = 7
    small: int = 32  # lines of a band that are compared with each other
    heads: int = 4  # lines of a larger band that all others are compared with first
    block: int = 512  # lines of a larger band that meet as many others under one key
    first_block: int = 128  # lines of a larger band that meet before all others do
    dealings: int = 2  # to such blocks
    odd_words: int = 8  # of 64 places each, of the bitmap that is asked first where lines of a large band meet
    sharp_words: int = 32  # of the larger bitmap, asked after the former; a multiple of it
    bits: int = 1 << 25  # of the bitmap that tells lines that may be needed
    seed: int = 11

    @property
    def values(self) -> int:
        return self.groups * self.width


VALUE_BITS = 21  # of a signature value; three come from one hash
SKETCH_BITS = 5  # of it in the sketch
STEP = 4  # n-grams that one row of the signatures' aggregate takes in


def _document(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


def normal(line: Column) -> Column:
    """Lines are compared in lower case and without white space at the ends."""
    return F.lower(F.btrim(line, F.lit(" \t\r\f\v ")))


def line_rows(docs: DataFrame) -> DataFrame:
    """(document, doc_id, line_no, line) of every line that is not blank; lines count from 0."""
    rows = docs.where(F.col("text").isNotNull()).select(
        _document(docs).alias("document"), F.col("doc_id").cast("long").alias("doc_id"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "raw"),
    )
    return rows.select("document", "doc_id", "line_no", normal(F.col("raw")).alias("line")).where("line <> ''")


def _code_units(line: Column) -> Column:
    return F.encode(line, "UTF-16BE")


def _gram(units: Column, at: Column, s: Settings) -> Column:
    return F.substring(units, at, F.lit(2 * s.gram))


def _last_place(units: Column, s: Settings) -> Column:
    """Where the last n-gram begins; a line of fewer code units has one n-gram, itself."""
    return F.greatest(F.lit(1), F.octet_length(units) - 2 * s.gram + 1)


def _places(units: Column, s: Settings) -> Column:
    """Where n-grams begin in the code units."""
    return F.sequence(F.lit(1), _last_place(units, s), F.lit(2))


def signatures(lines: DataFrame, s: Settings) -> DataFrame:
    """(id, packed): each line's signature, three values in a long.

    Every line is signed from all its n-grams, whatever its length.
    """
    rng = random.Random(s.seed)
    units = F.col("units")
    rows = (
        lines.select("id", _code_units(F.col("line")).alias("units"))
        .select("id", "units", _last_place(units, s).alias("last"))
        .select("id", "units", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(2 * STEP))).alias("at"))
    )
    # Behind the last n-gram a row takes that one again, which changes no minimum.
    places = [F.least(F.col("at") + 2 * k, F.col("last")) for k in range(STEP)]
    grams = rows.select("id", *(F.xxhash64(_gram(units, at, s)).alias(f"h{k}") for k, at in enumerate(places)))
    # Thirds of a hash of the n-gram's hash and a random number: every value orders the n-grams anew.
    numbers = [rng.getrandbits(63) for _ in range(-(-s.values // 3))]
    rehash = [F.xxhash64(f"h{k}", F.lit(r)).alias(f"r{i}_{k}") for i, r in enumerate(numbers) for k in range(STEP)]
    minima = []
    for i in range(s.values):
        thirds = [F.shiftleft(f"r{i // 3}_{k}", VALUE_BITS * (i % 3)) for k in range(STEP)]
        values = [F.shiftrightunsigned(x, 64 - VALUE_BITS).cast("int") for x in thirds]
        minima.append(F.min(F.least(*values)).alias(f"m{i}"))
    signed = grams.select("id", *rehash).groupBy("id").agg(*minima)
    packed = []
    for first in range(0, s.values, 3):
        word = F.lit(0).cast("long")
        for i in range(first, min(first + 3, s.values)):
            word = word.bitwiseOR(F.shiftleft(F.col(f"m{i}").cast("long"), VALUE_BITS * (i - first)))
        packed.append(word)
    return signed.select("id", F.array(*packed).alias("packed"))


def _value(i: int, bits: int = VALUE_BITS) -> Column:
    """The last bits of a signature's value."""
    return F.shiftrightunsigned(F.col("packed")[i // 3], VALUE_BITS * (i % 3)).bitwiseAND(F.lit((1 << bits) - 1))


def bands_of(s: Settings) -> Column:
    """A hash for each band of a line."""
    bands = []
    for g in range(s.groups):
        for left_out in range(s.width):
            held = [_value(g * s.width + i) for i in range(s.width) if i != left_out]
            bands.append(F.xxhash64(F.lit(len(bands)), *held))
    return F.array(*bands)


def sketch_of(s: Settings) -> Column:
    """The last bits of all values of a line's signature."""
    sketch = F.lit(0).cast("long")
    for i in range(s.values):
        sketch = sketch.bitwiseOR(F.shiftleft(_value(i, SKETCH_BITS), SKETCH_BITS * i))
    return sketch


def alike(x: Column, y: Column, s: Settings) -> Column:
    """Whether enough of two lines' signature values agree in their last bits."""
    differ = x.bitwiseXOR(y)
    for step in (1, 2, 1):  # any of five bits, gathered in the first
        differ = differ.bitwiseOR(F.shiftrightunsigned(differ, step))
    firsts = sum(1 << SKETCH_BITS * i for i in range(s.values))
    return F.bit_count(differ.bitwiseAND(F.lit(firsts))) <= s.most_unlike


def _grams(line: str, s: Settings) -> Column:
    """The set of a line's n-grams, each as a 64-bit hash."""
    # Bound to a name by the lambda, so that the line is encoded once.
    of = lambda units: F.array_distinct(
        F.transform(_places(units, s), lambda at: F.xxhash64(_gram(units, at, s)))
    )
    return F.transform(F.array(_code_units(F.col(line))), of)[0]


def oddities(texts: DataFrame, s: Settings, words: int | None = None) -> DataFrame:
    """(id, size, odd0, odd1 ...): the number of a line's n-grams, and a bitmap of the places that an odd number of them hits.

    An n-gram of both lines hits the same place twice. So two bitmaps differ in
    no more places than there are n-grams of one line only.
    """
    place = F.expr("shiftleft(1L, cast(h & 63 as int))")
    words = words or s.odd_words
    word = F.pmod(F.shiftrightunsigned("h", 6), F.lit(words))
    odd = [F.bit_xor(F.when(word == i, place).otherwise(F.lit(0).cast("long"))).alias(f"odd{i}") for i in range(words)]
    grams = texts.select("id", F.explode(_grams("line", s)).alias("h"))
    return grams.groupBy("id").agg(F.count("*").alias("size"), *odd)


def _of_sides(odd: DataFrame, ids: tuple[str, str], sides: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    return tuple(odd.select(F.col("id").alias(i), F.struct(*odd.columns[1:]).alias(side)) for i, side in zip(ids, sides))


def unlikeness(x: str, y: str, words: int | None = None) -> Column:
    """The least share of two lines' n-grams that are in one of them only, by their bitmaps.

    Those are ``words`` columns, or without a number an array: a join whose code
    has dozens of columns is too large for the JVM to compile.
    """
    differ = F.lit(0)
    for i in range(words or 0):
        differ = differ + F.bit_count(F.col(f"{x}.odd{i}").bitwiseXOR(F.col(f"{y}.odd{i}")))
    if words is None:
        differing = F.zip_with(f"{x}.odd", f"{y}.odd", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        differ = F.aggregate(differing, F.lit(0), lambda n, more: n + more)
    return differ / (F.col(f"{x}.size") + F.col(f"{y}.size"))


def may_be_similar(x: str, y: str, s: Settings, words: int | None = None) -> Column:
    """Whether the bitmaps do not show that two lines are less similar than wanted; true for all similar ones."""
    n, m, t = F.col(f"{x}.size"), F.col(f"{y}.size"), s.threshold
    # At similarity t, (1 - t) / (1 + t) of both lines' n-grams are in one of them only.
    return (F.least(n, m) >= t * F.greatest(n, m) - 1e-9) & (unlikeness(x, y, words) <= (1 - t) / (1 + t) + 1e-9)


def folded(odd: DataFrame, words: int) -> DataFrame:
    """The bitmaps of ``oddities`` with fewer words: what places of one number have in common is odd or even again."""
    return odd.select("id", "size", *_folds(odd, words))


def _folds(odd: DataFrame, words: int) -> list[Column]:
    names = odd.columns[2:]
    return [reduce(lambda x, y: x.bitwiseXOR(y), [F.col(c) for c in names[i::words]]).alias(f"odd{i}") for i in range(words)]


def not_ruled_out(pairs: DataFrame, odd: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose bitmaps do not show that they are less similar than wanted; no similar pair is lost."""
    a, b = _of_sides(odd, ("a", "b"), ("of_a", "of_b"))
    return pairs.join(a, "a").join(b, "b").where(may_be_similar("of_a", "of_b", s, len(odd.columns) - 2)).select("a", "b")


def similar(pairs: DataFrame, texts: DataFrame, s: Settings, odd: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) of ids whose lines have n-gram sets of at least the wanted similarity.

    Lines are read for those pairs only that ``not_ruled_out`` leaves by ``odd``, the lines' ``oddities``.
    """
    odd = staged(oddities(texts, s), "odd") if odd is None else odd
    return exactly_similar(not_ruled_out(pairs, odd, s), texts, s)


def exactly_similar(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """As ``similar``, for pairs that bitmaps have been asked about."""
    left = texts.select(F.col("id").alias("a"), F.col("line").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("right"))
    sets = F.array(F.struct(_grams("left", s).alias("l"), _grams("right", s).alias("r")))
    t = s.threshold

    def near(x: Column) -> Column:
        n, m = F.size(x["l"]), F.size(x["r"])
        both = F.size(F.array_intersect(x["l"], x["r"]))
        return (F.least(n, m) >= t * F.greatest(n, m) - 1e-9) & (both >= t * (n + m - both) - 1e-9)

    return pairs.join(left, "a").join(right, "b").where(F.exists(sets, near)).select("a", "b")


def possible(lines: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """The lines whose id may be among the wanted ones, told by a bitmap of fixed size."""
    place = F.pmod("id", F.lit(s.bits))
    number, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bitmap = wanted.groupBy(number.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright(_byte, cast(_bit % 8 as int))").bitwiseAND(F.lit(1)) == 1
    numbered = lines.withColumn("_bucket", number).withColumn("_bit", bit)
    # At most bits / 8 bytes, whatever the input.
    return numbered.join(F.broadcast(bitmap), "_bucket").withColumn("_byte", byte).where(held).select(*lines.columns)


def _ordered(x: Column, y: Column) -> tuple[Column, Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _mixed(rows: DataFrame) -> DataFrame:
    """``rows`` of the bands whose lines are not all of one component, with the band's size ``n``."""
    bands = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("x"), F.max("root").alias("y"))
    return rows.join(bands.where("x < y").select("band", "n"), "band")


def open_pairs(rows: DataFrame, s: Settings) -> DataFrame:
    """(a, b) of different components that share a band and have not met through its head.

    ``rows`` has band, id, sketch and root. Lines of a small band all meet each
    other; those of large ones meet a few of them here, the others in ``rest_pairs``.
    """
    rows = staged(_mixed(rows), "mixed")
    few = rows.where(F.col("n") <= s.small)
    other = few.select("band", *(F.col(c).alias(f"other_{c}") for c in ("id", "sketch", "root")))
    met = few.join(other, "band").where((F.col("id") < F.col("other_id")) & (F.col("root") != F.col("other_root")))
    found = met.where(alike(F.col("sketch"), F.col("other_sketch"), s)).select(F.col("id").alias("a"), F.col("other_id").alias("b"))
    rows = rows.where(F.col("n") > s.small)
    heads = rows.groupBy("band").agg(*(
        F.min_by(F.struct("id", "sketch", "root"), F.xxhash64(F.lit(i), "id")).alias(f"head{i}") for i in range(s.heads)
    ))
    heads = heads.select("band", F.explode(F.array_distinct(F.array(*(f"head{i}" for i in range(s.heads))))).alias("head"))
    met = rows.join(heads, "band").where((F.col("root") != F.col("head.root")) & alike(F.col("sketch"), F.col("head.sketch"), s))
    return found.unionByName(met.select(*_ordered(F.col("id"), F.col("head.id")))).distinct()


def rest_rows(rows: DataFrame, s: Settings) -> DataFrame:
    """``rows`` of the large bands that still have several components. Few bands have by now."""
    return _mixed(rows).where(F.col("n") > s.small)


def rest_pairs(rows: DataFrame, odd: DataFrame, s: Settings, dealings: int = 0) -> DataFrame:
    """(a, b, unlike) of different components that share a large band and may be similar by their bitmaps.

    ``rows`` are those of ``rest_rows``, ``odd`` has their ``oddities``. Lines of
    a band's largest component meet those of its other components, these also
    each other, whatever the band's size. Both sides are cut into blocks, so that
    a key of the join has a bounded number of lines. Bitmaps are compared where
    two lines meet, folded ones first: what they rule out is never made a row.

    With ``dealings``, lines are dealt to one block so many times and meet those
    dealt to the same one: a bounded number of others, whatever the band's size.
    """
    sizes = rows.groupBy("band", "root").agg(F.count("*").alias("size"))
    tops = sizes.groupBy("band").agg(
        F.max_by("root", F.struct("size", "root")).alias("top"), (F.sum("size") - F.max("size")).alias("others")
    )
    both = F.struct(F.struct("size", *_folds(odd, s.odd_words)).alias("few"), F.struct("size", F.array(*odd.columns[2:]).alias("odd")).alias("all"))
    own_odd, other_odd = (odd.select(F.col("id").alias(i), both.alias(x)) for i, x in (("id", "of_a"), ("other_id", "of_b")))
    rows = rows.join(tops, "band")

    def blocks(size: Column) -> Column:
        return F.ceil(size / (s.first_block if dealings else s.block)).cast("int")

    def own(size: Column) -> Column:
        return F.pmod(F.xxhash64("id"), blocks(size)).cast("int")

    def every(size: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(size) - 1))

    def dealt(side: DataFrame, line: str) -> DataFrame:
        blocks_of = [F.pmod(F.xxhash64(F.lit(i), line), blocks(F.col("n"))).cast("int") for i in range(dealings)]
        return side.select("*", F.posexplode(F.array(*blocks_of)).alias("x", "y"))

    left = rows.where(F.col("root") != F.col("top")).join(own_odd, "id").select("band", "id", "sketch", "root", "of_a", "n", "others")
    right = rows.select(
        "band", F.col("id").alias("other_id"), F.col("sketch").alias("other_sketch"), F.col("root").alias("other_root"),
        (F.col("root") == F.col("top")).alias("in_top"), own(F.col("n")).alias("y"), "n", "others",
    ).join(other_odd, "other_id")
    if dealings:
        left, right = dealt(left, "id"), dealt(right.drop("y"), "other_id")
    else:
        left = left.withColumn("x", own(F.col("others"))).withColumn("y", every(F.col("n")))
        right = right.withColumn("x", every(F.col("others")))
    left, right = left.drop("n", "others"), right.drop("n", "others")
    met = left.join(right, ["band", "x", "y"]).where(
        (F.col("root") != F.col("other_root")) & (F.col("in_top") | (F.col("id") < F.col("other_id")))
        & alike(F.col("sketch"), F.col("other_sketch"), s)
        & may_be_similar("of_a.few", "of_b.few", s, s.odd_words) & may_be_similar("of_a.all", "of_b.all", s)
    )
    unlike = unlikeness("of_a.all", "of_b.all").alias("unlike")
    return met.select(*_ordered(F.col("id"), F.col("other_id")), unlike).distinct()


def likeliest(pairs: DataFrame) -> DataFrame:
    """For each line its pair (a, b) that the bitmaps find most alike."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"), "a", "b", "unlike")
    best = F.min_by(F.struct("a", "b"), F.struct("unlike", "a", "b")).alias("best")
    return ends.groupBy("id").agg(best).select("best.*").distinct()


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component."""
    a, b = (roots.select(F.col("node").alias(i), F.col("root").alias(f"root_{i}")) for i in "ab")
    placed = pairs.join(a, "a", "left").join(b, "b", "left")
    return placed.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def line_classes(lines: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(node, root) for every line that has similar other lines.

    ``lines`` has id and line; equal lines have equal ids. All lines of a band
    are compared with one of it, its head. After union-find, the lines of bands
    that are not all in one component are compared by ``open_pairs``; what is in
    different components after another union-find, by ``rest_pairs``. So any two
    lines that share a band are compared or in one component already.
    """
    signed = staged(signatures(lines, s), "signed")
    # Bands and ids alone: few lines share a band with others, and only these need their sketches.
    # Without null ids, as the joins want them, on both ways, so that the bands are shuffled once for both.
    bands = signed.where("id IS NOT NULL").select(F.explode(bands_of(s)).alias("band"), "id").repartition("band")
    heads = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("id").alias("head")).where("n > 1").select("band", "head")
    # The few heads are hashed, so that the bands need not be sorted.
    shared = bands.join(heads.hint("shuffle_hash"), "band")
    sketches = signed.select("id", sketch_of(s).alias("sketch"))
    own = staged(shared.join(sketches.hint("merge"), "id"), "shared")
    of_heads = sketches.join(own.select(F.col("head").alias("id")).distinct().hint("merge"), "id")
    of_heads = of_heads.select(F.col("id").alias("head"), F.col("sketch").alias("head_sketch"))
    # A head may be that of many lines' bands; its rows meet one row here, split where they are many.
    members = split_left_join(own, of_heads, ["head"], "id", counted=own)
    first = members.where((F.col("id") != F.col("head")) & alike(F.col("sketch"), F.col("head_sketch"), s))
    pairs = staged(first.select(*_ordered(F.col("id"), F.col("head"))).distinct(), "pairs")
    remove(signed)

    # An inner join: a semi join would be moved below the bitmap's, and shuffle all lines.
    wanted = own.select("id").distinct()
    texts = staged(possible(lines.select("id", "line"), wanted, s).join(wanted, "id").dropDuplicates(["id"]), "texts")
    bitmaps: list[DataFrame] = []

    def odd_of(ids: DataFrame) -> DataFrame:
        """The bitmaps of these lines and of all that were asked for before."""
        fresh = texts.join(ids, "id")
        for made in bitmaps:
            fresh = fresh.join(made.select("id"), "id", "left_anti")
        bitmaps.append(staged(oddities(fresh, s, s.sharp_words), "odd"))
        return reduce(DataFrame.unionByName, bitmaps)

    def compared(candidates: DataFrame) -> DataFrame:
        odd = odd_of(candidates.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        return staged(similar(candidates, texts, s, odd), "edges")

    def placed(roots: DataFrame) -> DataFrame:
        return own.join(roots, own["id"] == roots["node"], "left").select(
            "band", "id", "sketch", F.coalesce("root", "id").alias("root")
        )

    def joined(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        if found.isEmpty():
            return edges, roots
        both = edges.unionByName(found)
        return both, components(both)

    edges = compared(pairs)
    roots = components(edges)
    with passing() as kept:
        candidates = kept(staged(open_pairs(placed(roots), s), "pairs"))
    if not candidates.isEmpty():
        edges, roots = joined(compared(candidates))
    # In bands larger than a first block, lines meet those of their blocks first: that joins most of what
    # is similar, so that few similar lines of different components are left when all others meet.
    for dealings, least in ((s.dealings, s.first_block), (0, s.small)):
        with passing() as kept:
            rest = staged(rest_rows(placed(roots), s).where(F.col("n") > least), "rest")
            if rest.isEmpty():
                continue
            odd = odd_of(rest.select("id").distinct())
            kept(bitmaps[-1])
            left = kept(staged(rest_pairs(rest, odd, s, dealings), "left"))
        # Most lines of one component need one of their pairs to be found in it.
        for chosen in (likeliest, lambda pairs: apart(pairs, roots)):
            edges, roots = joined(staged(exactly_similar(chosen(left), texts, s), "edges"))
        remove(left)
    for stored in (texts, *bitmaps):
        remove(stored)
    return roots


def removed_lines(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(document, removed): the numbers of the lines to take out of a document.

    Of each component of similar lines one occurrence stays, that of the
    smallest (doc_id, line number), a null doc_id coming first. Lines that are
    equal when normalised are one component whatever their length; blank lines
    are never taken out. Lines shorter than an n-gram are similar to equal ones
    only. Rows with equal doc_id and text are one document, and keep or lose
    the same lines. Line ids are 64-bit hashes.
    """
    with passing() as kept:
        places = staged(line_rows(docs).withColumn("id", F.xxhash64("line")), "lines", "zstd")
        roots = line_classes(places.select("id", "line"), s)
        repeated = places.groupBy("id").count().where("count > 1").select("id")
        classes = repeated.join(roots, repeated["id"] == roots["node"], "full_outer").select(
            F.coalesce("id", "node").alias("id"), F.coalesce("root", "id", "node").alias("root")
        )
        marked = kept(staged(places.join(classes, "id").select("root", "document", "doc_id", "line_no"), "marked"))
    place = F.struct("doc_id", "line_no", "document")
    first = marked.groupBy("root").agg(F.min(place).alias("kept"))
    met = split_left_join(marked.withColumn("place", place), first, ["root"], "place", counted=marked)
    return (
        met.where(~F.col("place").eqNullSafe(F.col("kept"))).select("document", "line_no").distinct()
        .groupBy("document").agg(F.sort_array(F.collect_list("line_no")).alias("removed"))
    )


def dedup_lines(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with the removed lines taken out of ``text``; adds ``n_lines`` and ``removed`` (numbers).

    All rows and columns are kept, whatever their names; columns ``n_lines`` and
    ``removed`` are replaced. A null text stays null, with 0 lines; a text may
    become empty. No rows give no rows.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "removed")]
    text_at = next(c for c in kept if c.lower() == "text")
    row = docs.select(
        _document(docs).alias("own"), docs["text"].alias("text"), F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    )
    lines = F.split("text", "\n")

    def without(x: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("removed"))
        return F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n")

    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.transform(F.array(lines), without)[0])
    joined = row.join(removed_lines(docs, s), F.col("own") == F.col("document"), "left")
    return joined.select(
        *(text.alias(c) if c == text_at else F.col("row")[c].alias(c) for c in kept),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )
