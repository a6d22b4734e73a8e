"""Languages of mixed texts: script ranges narrow the candidates, Viterbi labels the spans.

Letters count by language in hashed buckets of three letters, over all training texts. A word
is a run of letters of one script; only languages that use the script are candidates for it.
Its score by language is the log-probability of its letters. The best path through a text's
words pays a penalty for each switch of language; runs of one language on it are the spans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from purseline.llm.common import by_size, column_of, mix

# Fixed values of the contract: folds by id, the one that is held out, the label without letters.
FOLDS = 3
HELD_OUT = 1
UNKNOWN = "und"

# Where the Unicode standard puts the letters of a script.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "sinhala": ((0xD80, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "lao": ((0xE80, 0xEFF),),
    "tibetan": ((0xF00, 0xFFF),),
    "myanmar": ((0x1000, 0x109F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)),
}

#: Buckets of all languages together at most, so the model is at most 16 MB; and of one language.
CELLS = 1 << 22
BUCKETS = 1 << 16
#: Languages at most; more are an error, as then buckets would be few.
LANGUAGES = 4_096
#: A script belongs to a language that has this share of its letters in it.
USES = 0.001
#: Letters that a word counts for at most, and what a switch of language costs, in nats.
LETTERS = 12
SWITCH = 10.0
#: Texts walked through together; fewer are walked one by one.
FEW = 16

_AWAY = -1e6
_CODES = 0x110000


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its script, from 2 on (1: a letter of no listed one, 0: no letter); its lower case."""
    letters = np.fromiter(map(str.isalpha, map(chr, range(_CODES))), bool, _CODES)
    script = letters.astype(np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 2):
        for first, last in ranges:
            script[first : last + 1] = np.where(letters[first : last + 1], number, 0)
    lower = np.arange(_CODES, dtype=np.uint32)
    for i in np.flatnonzero(letters).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            lower[i] = ord(small)
    return script, lower


@dataclass
class Spelling:
    """The words of some texts: script, first and past-the-last letter, and hashed letters.

    ``texts`` numbers the text of each word; places count from the begin of that text.
    """

    texts: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    grams: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return self.ends - self.begins


def spell(texts: list[str | None]) -> Spelling:
    """All words; each letter is hashed with its neighbours, 0 beyond the ends of the word."""
    script_of, lower_of = _alphabet()
    texts = [text or "" for text in texts]
    # A line feed is no letter, so no word goes on into the next text.
    codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    script = script_of[codes]
    change = np.flatnonzero(script[1:] != script[:-1]) + 1
    begins, ends = change[:-1], change[1:]
    words = script[begins] > 0 if len(change) else np.empty(0, bool)
    begins, ends = begins[words], ends[words]
    letter = np.where(script > 0, lower_of[codes], 0).astype(np.uint64)
    before, after = np.roll(letter, 1), np.roll(letter, -1)
    before[begins] = 0
    after[ends - 1] = 0
    at = np.flatnonzero(script)
    grams = mix((letter[at] << np.uint64(42)) | (before[at] << np.uint64(21)) | after[at])
    starts = np.cumsum([1, *(len(text) + 1 for text in texts)])
    of = np.searchsorted(starts, begins, "right") - 1
    return Spelling(of, begins - starts[of], ends - starts[of], script[begins], grams)


@dataclass
class Model:
    """Log-probabilities by language and bucket; languages of a script; what a switch costs."""

    languages: list[str]
    table: np.ndarray
    uses: np.ndarray
    switch: float = SWITCH

    def scores(self, words: Spelling) -> np.ndarray:
        """By word and language; languages without the word's script are far away."""
        out = np.empty((len(words.begins), len(self.languages)))
        if not len(out):
            return out
        sizes = words.sizes
        first = np.cumsum(sizes) - sizes
        bucket = (words.grams % np.uint64(self.table.shape[1])).astype(np.int64)
        weight = np.minimum(sizes, LETTERS) / sizes
        for i, logs in enumerate(self.table):
            out[:, i] = np.add.reduceat(logs[bucket], first) * weight
        return np.where(self.uses[words.scripts], out, _AWAY)


def buckets_for(languages: int) -> int:
    """Buckets of a language: the power of two that keeps the model within ``CELLS``."""
    return min(BUCKETS, 1 << ((CELLS // max(1, languages)).bit_length() - 1))


def _count(languages: list[str], buckets: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Letters by language and bucket; scripts follow as buckets below 0."""
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((len(languages), buckets), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPTS) + 2), np.int64)
        for batch in by_size(batches, "body", 2_000_000):
            words = spell(batch["body"].tolist())
            of = batch["lang"].map(number).to_numpy(np.int64)[words.texts]
            np.add.at(scripts, (of, words.scripts), words.sizes)
            bucket = np.repeat(of, words.sizes) * buckets + (words.grams % np.uint64(buckets)).astype(np.int64)
            cells, times = np.unique(bucket, return_counts=True)
            held.ravel()[cells] += times
        for counts, sign in ((held, 1), (scripts, -1)):
            lang, bucket = np.nonzero(counts)
            place = bucket if sign > 0 else -1 - bucket
            yield pd.DataFrame({"lang": lang.astype(np.int32), "bucket": place.astype(np.int32), "n": counts[lang, bucket]})

    return count


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", switch: float = SWITCH) -> Model:
    """The model of all texts that have a language; each language value is one, '' as well."""
    known = docs.where(column_of(lang).isNotNull()).select(column_of(text).alias("body"), column_of(lang).cast("string").alias("lang"))
    found = [row["lang"] for row in known.select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = sorted(found)
    buckets = buckets_for(len(languages))
    table = np.zeros((len(languages), buckets), np.int64)
    scripts = np.zeros((len(languages), len(SCRIPTS) + 2), np.int64)
    if languages:
        counts = known.where("body is not null").mapInPandas(_count(languages, buckets), "lang int, bucket int, n long")
        counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        cells = counts.toPandas()  # at most CELLS and a few scripts by language
        letters = cells["bucket"] >= 0
        table[cells["lang"][letters], cells["bucket"][letters]] = cells["n"][letters]
        scripts[cells["lang"][~letters], -1 - cells["bucket"][~letters]] = cells["n"][~letters]
    total = table.sum(axis=1, keepdims=True)
    logs = np.log((table + 0.1) / (total + 0.1 * buckets)).astype(np.float32)
    uses = (scripts >= USES * np.maximum(total, 1)) & (scripts > 0)
    uses = uses.T
    uses[~uses.any(axis=1)] = True  # of a script that nobody uses any language may be
    return Model(languages, logs, uses, switch)


def best_path(scores: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word on the best path through its text.

    ``sizes`` are the words of each text. Ties stay with the language, then take the first.
    Texts are walked through side by side, word by word, the last few one by one.
    """
    stay = np.ones(scores.shape, bool)
    top = np.zeros(len(scores), np.int64)
    path = np.zeros(len(scores), np.int64)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    if not len(order):
        return path
    starts, lengths = starts[order], sizes[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), "left")  # texts longer than t words
    together = int(np.argmax(active < min(FEW, len(order)))) if len(order) >= FEW else 0
    state = scores[starts].copy()
    for t in range(1, together):
        n = active[t]
        at = starts[:n] + t
        now = state[:n]
        best = now.max(axis=1)
        top[at] = now.argmax(axis=1)
        least = (best - switch)[:, None]
        kept = now >= least
        stay[at] = kept
        state[:n] = np.where(kept, now, least) + scores[at]
    together = max(1, together)
    for i in range(int(np.searchsorted(-lengths, -together, "left"))):  # the rest of the longer ones
        a, b = int(starts[i]) + together, int(starts[i] + lengths[i])
        now, kept, tops = state[i].tolist(), [], []
        for row in scores[a:b].tolist():
            best = max(now)
            tops.append(now.index(best))
            least = best - switch
            kept.append([x >= least for x in now])
            now = [(x if x >= least else least) + y for x, y in zip(now, row, strict=True)]
        stay[a:b], top[a:b] = kept, tops
        last = now.index(max(now))
        state[i] = _AWAY
        for j in range(b - 1, a - 1, -1):
            path[j] = last
            if not kept[j - a][last]:
                last = tops[j - a]
        state[i, last] = 0.0
    last = state.argmax(axis=1)
    for t in range(min(together, int(lengths[0])) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = last[:n]
        last[:n] = np.where(stay[at, last[:n]], last[:n], top[at])
    return path


def label(texts: list[str | None], model: Model) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Per text its main language, how sure that is, and the spans ``(start, end, language)``.

    The main language has most letters on the path. Its score is the mean over all words of
    its probability for a word, given that the word is of one of the languages, where the path
    agrees, and 0 where it does not.
    """
    words = spell(texts)
    n, names = len(texts), model.languages
    if not names or not len(words.begins):
        return [(UNKNOWN, 0.0, []) for _ in texts]
    scores = model.scores(words)
    sizes = np.bincount(words.texts, minlength=n)
    path = best_path(scores, sizes, model.switch)
    cells = words.texts * len(names) + path
    letters = np.bincount(cells, weights=words.sizes, minlength=n * len(names)).reshape(n, -1)
    main = letters.argmax(axis=1)
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    sure = odds[np.arange(len(path)), path] / odds.sum(axis=1)
    sure = np.bincount(words.texts, weights=np.where(path == main[words.texts], sure, 0.0), minlength=n)
    cuts = np.flatnonzero(np.diff(cells)) + 1
    first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(cells)]]) - 1
    spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for i, a, b, lang in zip(words.texts[first], words.begins[first], words.ends[last], path[first], strict=True):
        spans[i].append((int(a), int(b), names[lang]))
    return [
        (names[main[i]], min(1.0, float(sure[i] / sizes[i])), spans[i]) if sizes[i] else (UNKNOWN, 0.0, [])
        for i in range(n)
    ]


def label_texts(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``id``, ``lang_pred``, ``score`` and ``spans`` in code points of the text.

    Whole texts of any length are read. NULL texts and those without a letter are ``und`` with
    score 0 and no spans; so is everything if the model has no language. Equal texts get equal
    answers, so repeated rows do. Ties go to the language that is first in code point order.
    Columns of other names are not read, an empty table has no rows.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_size(batches, "body", 2_000_000):
            out = pd.DataFrame(label(batch["body"].tolist(), model), columns=["lang_pred", "score", "spans"])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    rows = docs.select(column_of(id).cast("string").alias("id"), column_of(text).alias("body"))
    schema = "id string, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"
    out = rows.mapInPandas(read, schema)
    return out.select(F.col("id").cast(docs.schema[id].dataType).alias(id), "lang_pred", "score", "spans")


def held_out(id: str) -> Column:
    """Whether the row's fold is the one not learned from; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(column_of(id).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def language_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract, and how many spans and languages a text has."""
    model = learn(docs.where(~held_out("doc_id")))
    out = label_texts(docs, model).withColumn("held_out", held_out("doc_id"))
    langs = F.size(F.array_distinct(F.transform("spans", lambda x: x["lang"]))).cast("long")
    return out.select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"), langs.alias("n_langs")
    )
