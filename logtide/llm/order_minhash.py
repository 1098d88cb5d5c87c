"""Order MinHash fingerprints (Marçais and others, 2019): sensitive to the order of a text.

A text is cut into units, words or parts of words, without loss. Its items are its k-mers, K consecutive
units each, numbered by their occurrence, so that a repeated k-mer is several items. For every sketch a random order of the items selects the
TUPLE least ones; they are put back in the order of the text, and the hash of their k-mers is the
sketch. Two texts' share of equal sketches is their likeness: other than MinHash, it
falls when parts change places, and it bounds the edit distance.

The orders are the turns of one hashed circle: an item lies at the hash of its k-mer, turned
by its number of earlier occurrences, and sketch j takes the first items from the j-th of
SKETCHES even points on. One sort of a text's items serves all sketches, each by a binary search, so a
text of n units takes n log n steps. k-mers are hashed to 36 bits here; those that
collide within a text are counted as the same k-mer.

All of it is built-in functions on arrays within a row; texts are shuffled only to meet the document
that follows them.

Defined results: a null text is empty. A text of fewer than K units is its own only k-mer, the empty text has
none, and all its sketches are 0; a text of fewer than TUPLE items uses what it has. Equal texts
have equal fingerprints. Texts may be as long as Spark's rows (up to 2^27 k-mers). Columns
of the results' names are replaced, others carried by :func:`order_minhash`. Documents of
one doc_id follow each other by hash of their texts; those without one come first, and a
single document follows itself. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name

#: What a text is cut into: six code points of a word at most, with the white space behind them.
UNIT = r"\S{1,6}\s*|\s+"
#: Units of a k-mer, items of a tuple, sketches of a fingerprint (16 bits each).
K = 2
TUPLE = 2
SKETCHES = 64

#: An item is a long: where it lies on the circle, then the place of its k-mer in the text, from 1.
_PLACE = 27
_CIRCLE = 36
_AROUND = (1 << _CIRCLE) - 1
#: Number of the turn for each earlier occurrence: odd, from the golden ratio.
_STEP = 42470972311

#: Blocks of neighbouring documents for each shuffle partition.
BLOCKS = 4


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _powers(n: Column) -> Column:
    """The powers of two up to n, falling; 1 at least."""
    return F.transform(F.sequence(F.length(F.bin(n)) - 1, F.lit(0), F.lit(-1)), lambda b: F.call_function("shiftleft", F.lit(1), b))


def _number_below(items: Column, powers: Column, limit: Column) -> Column:
    """How many of the sorted items are below the limit."""
    return F.aggregate(powers, F.lit(0), lambda low, p: F.when(F.get(items, low + p - 1) < limit, low + p).otherwise(low))


def _turn(earlier: int | Column) -> int | Column:
    """What the place on the circle of a k-mer that occurred so often before is turned by."""
    if isinstance(earlier, int):
        return (earlier * _STEP & _AROUND) << _PLACE
    return F.shiftleft((earlier.cast("long") * F.lit(_STEP)).bitwiseAND(_AROUND), _PLACE)


def _numbered(items: Column, powers: Column) -> Column:
    """Sorted items, those of a repeated k-mer turned by its earlier occurrences."""

    def item(x: Column, i: Column) -> Column:
        def is_same(back: int) -> Column:
            return F.get(items, i - back).bitwiseXOR(x) < (1 << _PLACE)  # null before the first

        first = x - x.bitwiseAND((1 << _PLACE) - 1)
        often = x.bitwiseXOR(_turn(i - _number_below(items, powers, first)))
        thrice = F.when(is_same(3), often).otherwise(x.bitwiseXOR(F.lit(_turn(2))))
        twice = F.when(is_same(2), thrice).otherwise(x.bitwiseXOR(F.lit(_turn(1))))
        return F.when(is_same(1), twice).otherwise(x)

    return F.transform(items, item)


def _sketches(hashed: Column, circle: Column, powers: Column, sketches: int, size: int) -> Column:
    """The sketches from a text's items in the text's order and those on the circle, sorted."""
    points = F.lit([j * (1 << _CIRCLE) // sketches << _PLACE for j in range(sketches)])
    n = F.size(circle)

    def sketch(point: Column) -> Column:
        def of(low: Column) -> Column:
            taken = [F.when(n > t, F.get(circle, (low + t) % n).bitwiseAND((1 << _PLACE) - 1).cast("int")) for t in range(size)]
            return _let(F.sort_array(F.array(*taken)), lambda places: F.xxhash64(
                *[F.get(hashed, F.get(places, F.lit(t)) - 1).bitwiseAND(_AROUND << _PLACE) for t in range(size)]))

        return _let(_number_below(circle, powers, point), of).bitwiseAND(0xFFFF).cast("int")

    return F.when(n > 0, F.transform(points, sketch)).otherwise(F.array_repeat(F.lit(0), sketches))


def order_minhash(df: DataFrame, column: str, out: str, k: int = K, size: int = TUPLE, sketches: int = SKETCHES) -> DataFrame:
    """``df`` with the array ``out``: the sketches (0 to 65535) of a text column."""
    units, hashed, items, circle, powers = (free_name(df, f"_{n}") for n in ("units", "hashed", "items", "circle", "powers"))

    def item(i: Column) -> Column:
        kmer = F.xxhash64(*[F.get(units, i + j) for j in range(k)])  # the last of a short text: null, which is skipped
        return F.shiftleft(kmer, _PLACE).bitwiseAND(_AROUND << _PLACE).bitwiseOR((i + 1).cast("long"))

    # a column that a step uses more than once stays a step of its own; sorting an array is
    # fast as a step and slow within another function
    steps = df.withColumn(units, F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(UNIT), F.lit(0)))
    steps = steps.withColumn(hashed, F.when(F.size(units) > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(units) - k, F.lit(0))), item)).otherwise(F.array().cast("array<long>"))).drop(units)
    steps = steps.withColumns({items: F.sort_array(hashed), powers: _powers(F.size(hashed))})
    steps = steps.withColumn(circle, F.sort_array(_numbered(F.col(items), F.col(powers))))
    return (steps.withColumn(out, _sketches(F.col(hashed), F.col(circle), F.col(powers), sketches, size))
            .drop(hashed, items, circle, powers))


def fingerprint(sketches: Column) -> Column:
    """The sketches as text, four lowercase hex digits each."""
    return F.array_join(F.transform(sketches, lambda s: F.lpad(F.lower(F.hex(s)), 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a).cast("double")


def _bounds(keys: DataFrame, blocks: int) -> list[int]:
    """Rising keys, the least one first, that part the rows into blocks of about the same size."""
    cuts = [i / blocks for i in range(1, blocks)]
    found = keys.agg(F.min("key").alias("least"), F.percentile_approx("key", cuts, 10 * blocks).alias("cuts")).first()
    return sorted({found.least, *(found.cuts or [])}) if found.least is not None else [0]


def with_next(df: DataFrame, doc_id: str, columns: dict[str, str], order: str) -> DataFrame:
    """``df`` with the values that ``columns`` (column: new name) have in the row that follows by
    ``doc_id`` and then ``order``; after the last comes the first.

    Rows are dealt to blocks of neighbouring ids, whose bounds are ids of rows. A row at a
    block's lower bound is dealt to the block before as well, behind its rows: it is what follows the last.
    """
    spark = df.sparkSession
    key, block, guest = (free_name(df, f"_{n}") for n in ("key", "block", "guest"))
    keyed = df.withColumn(key, F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)).cast("long")))
    blocks = max(2, BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(keyed.select(F.col(key).alias("key")), blocks)
    held = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")  # a number for each block
    own = F.aggregate(F.lit([1 << b for b in reversed(range(len(bounds).bit_length()))]), F.lit(0),
                      lambda low, p: F.when(F.get(held, low + p) <= F.col(key), low + p).otherwise(low))
    dealt = keyed.withColumn(block, own)
    before = F.pmod(F.col(block) - 1, F.lit(len(bounds)))
    places = F.when(F.get(held, F.col(block)) == F.col(key), F.array(
        F.struct(F.col(block).alias("b"), F.lit(False).alias("g")), F.struct(before.alias("b"), F.lit(True).alias("g")))
    ).otherwise(F.array(F.struct(F.col(block).alias("b"), F.lit(False).alias("g"))))
    dealt = (dealt.withColumn(block, F.explode(places)).withColumns({guest: F.col(block)["g"], block: F.col(block)["b"]}))
    following = Window.partitionBy(block).orderBy(guest, key, order)
    return (dealt.withColumns({new: F.lead(c).over(following) for c, new in columns.items()})
            .filter(~F.col(guest)).drop(key, block, guest))


def edited(text: Column, following: Column) -> Column:
    """The text, its last floor(n / 2) code points replaced by the first as many of the one that follows."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = order_minhash(rows, "text", "sketches").withColumn("tie", F.xxhash64("text"))
    pairs = with_next(own, "doc_id", {"text": "next_text", "sketches": "next_sketches"}, "tie")
    changed = pairs.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketches", "next_sketches",
                           edited(F.col("text"), F.col("next_text")).alias("text"))
    both = order_minhash(changed, "text", "edited_sketches")
    return both.select("doc_id", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("edited_sha256"),
                       fingerprint(F.col("sketches")).alias("fingerprint"),
                       fingerprint(F.col("edited_sketches")).alias("edited_fingerprint"),
                       likeness(F.col("sketches"), F.col("edited_sketches")).alias("near_edited"),
                       likeness(F.col("sketches"), F.col("next_sketches")).alias("near_next"))
