"""Sets of days packed into 64-day words.

A set is a struct of ``first`` (the number of its first word, counted from the
epoch day 0) and ``words`` (one LONG per 64 days, bit k = the word's k-th day).
It is lossless and ordered by nature; a year of days takes 6 words, 48 bytes,
where an array of dates takes up to 1,460. All functions are expressions over
one row's columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col_of

WORD_DAYS = 64
EMPTY_WORD = 0


def epoch_day(day: str | Column) -> Column:
    return F.datediff(col_of(day), F.lit("1970-01-01").cast("date"))


def word_of(day: str | Column) -> Column:
    """Number of the word that holds a day."""
    return F.floor(epoch_day(day) / F.lit(WORD_DAYS)).cast("int")


def bit_of(day: str | Column) -> Column:
    """The day's bit in its word."""
    return F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(epoch_day(day), F.lit(WORD_DAYS)).cast("int")
    )


def _zero() -> Column:
    return F.lit(EMPTY_WORD).cast("bigint")


def set_of_words(entries: str | Column) -> Column:
    """From an array of structs (word, bits), one for each word that is not empty, to a set."""
    e = col_of(entries)
    bits = F.map_from_entries(e)
    numbers = F.transform(e, lambda x: x["word"])
    first = F.array_min(numbers)
    words = F.transform(
        F.sequence(first, F.array_max(numbers)), lambda w: F.coalesce(F.try_element_at(bits, w), _zero())
    )
    return F.struct(first.alias("first"), words.alias("words"))


def entries_of(days: str | Column) -> Column:
    """The set's array of structs (word, bits); empty for a NULL set."""
    s = col_of(days)
    found = F.transform(s["words"], lambda bits, i: F.struct((s["first"] + i).alias("word"), bits.alias("bits")))
    return F.coalesce(found, F.array().cast("array<struct<word:int,bits:bigint>>"))


def pack(dates: str | Column) -> Column:
    """A set from an array of dates (repeats are harmless); NULL for an empty or NULL array."""
    d = F.array_compact(col_of(dates))
    first = word_of(F.array_min(d))
    last = word_of(F.array_max(d))

    def word(w: Column) -> Column:
        own = F.filter(d, lambda x: word_of(x) == w)
        return F.aggregate(own, _zero(), lambda acc, x: acc.bitwiseOR(bit_of(x)))

    return F.when(
        F.size(d) > 0, F.struct(first.alias("first"), F.transform(F.sequence(first, last), word).alias("words"))
    )


def unpack(days: str | Column) -> Column:
    """The set's days in ascending order."""
    s = col_of(days)

    def of_word(bits: Column, i: Column) -> Column:
        start = (s["first"] + i) * WORD_DAYS
        held = F.filter(
            F.sequence(F.lit(0), F.lit(WORD_DAYS - 1)),
            lambda k: F.call_function("shiftright", bits, k).bitwiseAND(F.lit(1).cast("bigint")) == 1,
        )
        return F.transform(held, lambda k: F.date_add(F.lit("1970-01-01").cast("date"), start + k))

    return F.flatten(F.transform(s["words"], of_word))


def upto(days: str | Column, day: str | Column) -> Column:
    """The set without the days after ``day`` (its empty words stay)."""
    s, w, e = col_of(days), word_of(day), epoch_day(day)
    # bits 0 .. k of the day's own word
    own = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(WORD_DAYS - 1) - F.pmod(e, F.lit(WORD_DAYS)))
    words = F.transform(
        s["words"],
        lambda bits, i: F.when(s["first"] + i < w, bits).when(s["first"] + i == w, bits.bitwiseAND(own)).otherwise(_zero()),
    )
    return F.struct(s["first"].alias("first"), words.alias("words"))


def size(days: str | Column) -> Column:
    """Number of days in the set."""
    return F.aggregate(col_of(days)["words"], F.lit(0), lambda acc, bits: acc + F.bit_count(bits).cast("int"))


def window_bits(days: str | Column, as_of: str | Column, width: int = 32) -> Column:
    """The last ``width`` days up to ``as_of`` as a bitmap whose highest bit is the as-of day; at most 64 days."""
    s, e = col_of(days), epoch_day(as_of)
    w, k = word_of(as_of), F.pmod(e, F.lit(WORD_DAYS))
    own = F.coalesce(F.get(s["words"], w - s["first"]), _zero())
    before = F.coalesce(F.get(s["words"], w - 1 - s["first"]), _zero())
    own = F.when(w >= s["first"], own).otherwise(_zero())
    before = F.when(w - 1 >= s["first"], before).otherwise(_zero())
    # the as-of day moves to bit 63; days after it are shifted out
    high = F.call_function("shiftleft", own, F.lit(WORD_DAYS - 1) - k)
    low = F.when(k == WORD_DAYS - 1, _zero()).otherwise(F.call_function("shiftrightunsigned", before, k + 1))
    return F.call_function("shiftrightunsigned", high.bitwiseOR(low), F.lit(WORD_DAYS - width))
