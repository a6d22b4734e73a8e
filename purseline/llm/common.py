"""Words, hashes and small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two word patterns of the contracts.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACES = " \t\n\x0b\x0c\r"

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHIFT = np.uint64(33)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: str) -> str:
    """A-Z to a-z and nothing else; the number of code points stays."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def terms(text: str | None) -> list[str]:
    """Lower-cased runs of ASCII letters, digits and any other non-ASCII character."""
    return TERM.findall(ascii_lower(text)) if text else []


def raw(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def words(text: str | None) -> list[bytes]:
    """Runs between ASCII white space (``bytes.split`` knows exactly 0x20 and 0x09-0x0D)."""
    return raw(text).split()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column_of(name: str) -> Column:
    """The column of this name, dots and backticks in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Bits per member, and at most, of a filter that rows pass before they are shuffled.
FILTER_LOAD = 16
FILTER_BITS = 1 << 26


class MemberFilter:
    """A set of bits by 64-bit hash that knows all members, and lets some others through.

    It is bounded, so it is broadcast; if members outgrow it, it lets more through. What decides
    in the end is the join that follows, over the rows that passed.
    """

    def __init__(self, members: DataFrame, hash: str):
        """``members`` is a written table."""
        self.bits = min(FILTER_BITS, 1 << max(16, (FILTER_LOAD * members.count()).bit_length()))
        self.words = members.groupBy(self._word(hash).alias("_word")).agg(F.bit_or(self._bit(hash)).alias("_bits"))

    def _word(self, of: str) -> Column:
        return F.floor(F.pmod(F.col(of), F.lit(self.bits)) / 64)

    def _bit(self, of: str) -> Column:
        return F.expr(f"shiftleft(cast(1 as bigint), cast(pmod({of}, 64) as int))")

    def split(self, rows: DataFrame, hash: str, passing: bool = True) -> DataFrame:
        """The rows that pass, or those that certainly are no members; none is shuffled."""
        held = rows.withColumn("_of", self._word(hash)).join(F.broadcast(self.words), F.col("_of") == F.col("_word"), "left")
        known = F.coalesce(F.col("_bits").bitwiseAND(self._bit(hash)) != 0, F.lit(False))
        return held.where(known if passing else ~known).drop("_of", "_word", "_bits")


def most_frequent(counts: DataFrame, most: int, n: str = "n") -> DataFrame:
    """The rows with the largest counts, in whole levels of counts, at most ``most`` rows.

    Levels are sixteenths of a power of two, so about a thousand numbers decide; a sort with a
    limit would send the first rows of every task to one place.
    """
    level = F.floor(F.log2(n) * 16)
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("size")).collect()
    held, least = 0, None
    for row in sorted(sizes, key=lambda x: -x["level"]):
        held += row["size"]
        if held > most:
            break
        least = row["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def by_size(batches: Iterator[pd.DataFrame], column: str, most: int = 6_000_000) -> Iterator[pd.DataFrame]:
    """The rows in pieces whose texts have at most ``most`` code points, or are one text.

    Bounds what a task holds at a time where it lists the words of many texts.
    """
    for batch in batches:
        sizes = batch[column].str.len().fillna(0).to_numpy(np.int64)
        a, held = 0, 0
        for b, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.iloc[a:b]
                a, held = b, 0
            held += size
        if a < len(batch):
            yield batch.iloc[a:]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    values = values ^ (values >> _SHIFT)
    values = values * _MIX[0]
    values = values ^ (values >> _SHIFT)
    values = values * _MIX[1]
    return values ^ (values >> _SHIFT)


class Words:
    """The words of several texts, one after another, as places in one string.

    ``whole`` has them with single spaces between; ``begins`` and ``ends`` are their bytes,
    ``sizes`` the words of each text and ``starts`` where they begin, ``hashes`` 64-bit hashes.
    """

    def __init__(self, texts: list[bytes], normal: bool = False):
        """``normal``: the texts are words with single spaces between already."""
        lines = texts if normal else [b" ".join(text.split()) for text in texts]
        self.sizes = np.fromiter((x.count(b" ") + 1 if x else 0 for x in lines), np.int64, len(lines))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.whole = b" ".join(filter(None, lines))
        gaps = np.flatnonzero(np.frombuffer(self.whole, np.uint8) == 32)
        some = self.starts[-1] > 0
        self.begins = np.concatenate([[0], gaps + 1]) if some else np.empty(0, np.int64)
        self.ends = np.concatenate([gaps, [len(self.whole)]]) if some else np.empty(0, np.int64)
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Eight bytes at a time; words of up to eight bytes cannot collide with each other."""
        eights = np.ndarray((len(self.whole) + 1,), "<u8", self.whole + bytes(8), 0, (1,))
        left = self.ends - self.begins
        out = left.astype(np.uint64) * _STEP
        at, active = self.begins, None
        while True:
            part = mix((out if active is None else out[active]) + (eights[at] & _MASKS[np.minimum(left, 8)]))
            if active is None:
                out = part
            else:
                out[active] = part
            longer = left > 8
            if not longer.any():
                return out
            active = np.flatnonzero(longer) if active is None else active[longer]
            at, left = at[longer] + 8, left[longer] - 8


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive words, by doubling."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    done, span, whole, place = None, 1, hashes, 0
    while True:
        if length & span:
            part = whole[place : place + len(hashes) - length + 1]
            done = mix(part) if done is None else mix(done * _STEP + part)
            place += span
        if place == length:
            return done
        whole = mix(whole[:-span] * np.uint64(0xD6E8FEB86659FD93) + whole[span:])
        span *= 2


def group_ends(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last index of each run of equal values in a sorted array."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(values)]])
