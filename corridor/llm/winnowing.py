"""Document fingerprints by winnowing, in DataFrame functions alone.

All overlapping runs of ``GRAM`` bytes of a text (in UTF-8) are hashed; of every ``WINDOW``
consecutive hashes the smallest is kept, the rightmost of equal ones, together with its position in
bytes. Two texts that share ``GRAM + WINDOW - 1`` bytes in a row therefore share a mark
(``guaranteed``), and no run shorter than ``GRAM`` is ever compared.

A hash and its place in the part are one number, ``hash << 15 | (32767 - place)``: the smallest such
number of a window is its rightmost smallest hash. Window minima come from arrays compared with
themselves a step further on, the step doubling, so no window is cut out. SQL has no state between
array elements, so each gram is hashed as a whole instead of from its predecessor's hash; bytes can
be cut out without counting characters from the beginning, which makes that cheap.

A text is taken in parts of ``PART`` bytes that reach far enough into the next part to hold every
window beginning in them: grams and windows of one part at a time are in memory, however long the
text, and the marks are those of the whole text.

Null counts as empty; an empty text has no marks and an empty fingerprint. A text of fewer bytes
than a gram is one gram, one of fewer grams than a window is one window. Equal texts have equal
fingerprints.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.session import settle

GRAM = 12
WINDOW = 16
#: Bytes of a part; its places, with those of the window that reaches beyond it, fit 15 bits.
PART = 1 << 13
PLACES = (1 << 15) - 1
#: Hex digits of the 49 bits that are left of a hash, with a leading one.
DIGITS = 13

#: Neighbouring documents are brought together in blocks of about so much text, at most so many.
BLOCK_BYTES = 4 << 20
MOST_BLOCKS = 4096
#: Ids drawn to cut the blocks; the cuts balance the work and change no result.
DRAWN = 500_000


def guaranteed(gram: int = GRAM, window: int = WINDOW) -> int:
    """Bytes in a row that two texts must share to be sure of sharing a mark."""
    return gram + window - 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _widened(numbers: Column, window: int, covered: int = 1) -> Column:
    """The smallest of the ``window`` numbers from each place on, or of what is left of them there.

    ``numbers`` holds the smallest of ``covered`` numbers in a row.
    """
    if covered == window:
        return numbers
    step = min(covered, window - covered)
    # beyond the end the second array holds null, which least() leaves out
    wider = F.zip_with(numbers, F.slice(numbers, step + 1, F.size(numbers)), lambda one, other: F.least(one, other))
    return _bound(wider, lambda found: _widened(found, window, covered + step))


def _marks_of(whole: Column, gram: int, window: int, part: int, offset: Column | None = None) -> Column:
    """Marks of bytes that are not empty and begin ``offset`` bytes into their text."""
    if not 0 < part <= PLACES - window:
        raise ValueError("the places of a part must fit their bits")

    def placed(piece: Column) -> Column:
        def one(at: Column) -> Column:
            return F.shiftleft(F.xxhash64(F.substring(piece, at + 1, F.lit(gram))), 15).bitwiseOR((F.lit(PLACES) - at).cast("bigint"))

        return F.transform(F.sequence(F.lit(0), F.greatest(F.length(piece) - gram, F.lit(0))), one)

    def kept(hashes: Column) -> Column:
        # every window but the partial ones at the end, and one at least
        windows = F.greatest(F.size(hashes) - (window - 1), F.lit(1))
        return F.slice(_widened(hashes, window), F.lit(1), windows)

    windows = F.greatest(F.length(whole) - (gram + window - 2), F.lit(1))

    def of_part(number: Column) -> Column:
        piece = F.substring(whole, (number * part).cast("int") + 1, F.lit(part + gram + window - 2))
        begin = number * part + PLACES if offset is None else number * part + PLACES + offset

        def mark(one: Column) -> Column:
            at = begin - one.bitwiseAND(F.lit(PLACES))
            return F.struct(F.shiftrightunsigned(one, 15).alias("hash"), at.alias("at"))

        return F.transform(F.array_distinct(_bound(_bound(piece, placed), kept)), mark)

    # Places of windows never go back, so two parts share at most the mark where they meet.
    found = F.flatten(F.transform(F.sequence(F.lit(0), F.floor((windows - 1) / part)), of_part))
    return _bound(found, lambda all_: F.filter(all_, lambda one, i: (i == 0) | (one["at"] != F.get(all_, i - 1)["at"])))


MARKS = "array<struct<hash:bigint,at:bigint>>"


def marks(text: Column, gram: int = GRAM, window: int = WINDOW, part: int = PART) -> Column:
    """The kept marks of a whole text by position: (hash, at), a hash of 49 bits and bytes from 0."""
    text = F.coalesce(text, F.lit(""))
    found = _bound(text.cast("binary"), lambda whole: _marks_of(whole, gram, window, part))
    return F.when(text == "", F.array().cast(MARKS)).otherwise(found)


def marks_after(before: Column, begin: Column, end: Column, gram: int = GRAM, window: int = WINDOW, part: int = PART) -> Column:
    """Marks of ``begin || end``, where ``before`` are the marks of a text that begins with ``begin``.

    Only windows that reach into ``end`` are taken anew. Places of windows never go back: up to the
    place of the last window wholly inside ``begin`` the marks are those of ``before``.
    """
    length = F.octet_length(begin)
    start = F.greatest(length - (gram + window - 1), F.lit(0))
    tail = F.concat(F.substring(begin.cast("binary"), start + 1, length), end.cast("binary"))

    def joined(late: Column) -> Column:
        kept = F.concat(F.filter(before, lambda one: one["at"] < F.get(late, F.lit(0))["at"]), late)
        return F.when(start > 0, kept).otherwise(late)

    found = _bound(_bound(tail, lambda whole: _marks_of(whole, gram, window, part, start.cast("bigint"))), joined)
    return F.when(F.length(tail) == 0, F.array().cast(MARKS)).otherwise(found)


def fingerprint(found: Column) -> Column:
    """``hash:at`` of all marks; hashes have a leading one, so all are of ``DIGITS`` hex digits."""

    def word(one: Column) -> Column:
        return F.concat(F.hex(one["hash"].bitwiseOR(F.lit(1 << 49))), F.lit(":"), one["at"].cast("string"))

    return F.array_join(F.transform(found, word), " ")


def mark_hashes(found: Column) -> Column:
    """The different hashes of marks."""
    return F.array_distinct(F.transform(found, lambda one: one["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Twice the hashes in both over the hashes of each: 0 to 1; two empty texts are alike."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / F.greatest(total, F.lit(1)))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint, marks, hashes) of every row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = docs.select(F.col(id_column), F.char_length(text).cast("bigint").alias("n_chars"), marks(text).alias("marks"))
    return found.withColumns({"fingerprint": fingerprint(F.col("marks")), "hashes": mark_hashes(F.col("marks"))})


def _block_cuts(docs: DataFrame, block_bytes: int) -> list[int]:
    """Ids that cut the rows into blocks of about ``block_bytes`` of text."""
    rows, size = docs.agg(F.count("id"), F.sum(F.octet_length("text"))).first()
    blocks = min(MOST_BLOCKS, ceil((size or 0) / block_bytes))
    if blocks < 2 or not rows:
        return []
    drawn = docs.select("id").filter(F.pmod(F.xxhash64("id"), F.lit(max(1, rows // DRAWN))) == 0)
    shares = [k / blocks for k in range(1, blocks)]
    return sorted(set(drawn.agg(F.percentile_approx("id", shares, 10 * blocks)).first()[0] or []))


def _block_of(value: Column, cuts: list[int]) -> Column:
    """How many cuts lie at or below the value; -1 for null. The size of the expression does not depend on the cuts."""
    if not cuts:
        return F.when(value.isNull(), -1).otherwise(0)
    steps = [1 << bit for bit in reversed(range(len(cuts).bit_length()))]

    def step(found: Column, size: Column) -> Column:
        return F.when(F.get(F.lit(cuts), found + size - 1) <= value, found + size).otherwise(found)

    return F.when(value.isNull(), -1).otherwise(F.aggregate(F.lit(steps), F.lit(0), step))


def in_neighbour_blocks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, text, block, beyond): every row in its block of ids, and the first rows of each block, descending
    by id, once more in the block before (``beyond``); those of the first block also end the last.

    Only blocks and their largest ids are joined, at most ``MOST_BLOCKS`` + 1 rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    cuts = _block_cuts(rows, block_bytes)
    rows = rows.withColumn("own", _block_of(F.col("id"), cuts))
    heads = settle(rows.groupBy("own").agg(F.max("id").alias("head")), "heads")
    # as many rows as blocks: an unpartitioned window over them stays small
    upward = Window.orderBy("own")
    lowest = F.min("own").over(Window.partitionBy())
    before = heads.select("own", "head", F.coalesce(F.lead("own").over(upward), lowest).alias("before"))
    joined = rows.join(F.broadcast(before), "own")
    here = F.struct(F.col("own").alias("block"), F.lit(False).alias("beyond"))
    there = F.struct(F.col("before").alias("block"), F.lit(True).alias("beyond"))
    places = F.when(F.col("id").eqNullSafe(F.col("head")), F.array(here, there)).otherwise(F.array(here))
    return joined.select("id", "text", F.explode(places).alias("at")).select("id", "text", "at.block", "at.beyond")


def compared_with_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next row.

    The next row is the one with the next smaller id (rows without id come last, rows of one id by
    text, ascending); after the last comes the first. In the edited text the last half of the code
    points, rounded down, is replaced by the first as many of the next text, or all of it.

    Texts are shuffled once, by blocks of neighbouring ids; both windows use that partitioning. Rows
    of one id are one block, which a task streams through.
    """
    placed = in_neighbour_blocks(docs, id_column, text_column, block_bytes)
    order = Window.partitionBy("block").orderBy("beyond", F.col("id").desc_nulls_last(), "text")
    n, taken = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    halves = {
        "begin": F.col("text").substr(F.lit(1), n - taken),
        "end": F.coalesce(F.col("next").substr(F.lit(1), taken), F.lit("")),
    }
    paired = placed.withColumn("next", F.lead("text").over(order)).withColumns(halves).drop("next")
    found = paired.withColumn("marks", marks(F.col("text")))
    edited = marks_after(F.col("marks"), F.col("begin"), F.col("end"))
    found = found.withColumn("edited_marks", F.when(F.col("beyond"), F.array().cast(MARKS)).otherwise(edited))
    found = found.withColumns({"hashes": mark_hashes(F.col("marks")), "edited_hashes": mark_hashes(F.col("edited_marks"))})
    judged = found.select(
        "block", "beyond", "id", "text", "hashes", n.cast("bigint").alias("n_chars"),
        F.sha2(F.concat("begin", "end"), 256).alias("edited_sha256"),
        fingerprint(F.col("marks")).alias("fingerprint"), fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
    )
    follower = judged.withColumn("next_hashes", F.lead("hashes").over(order)).filter(~F.col("beyond"))
    return follower.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
