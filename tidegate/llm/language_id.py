"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A gram of
three places inside a word (a word's edge counts as a place) is bound by multiplying its
letters' vectors, each rotated by its place. A text is the sum of its grams' vectors, a
language's prototype the sum of its training texts. A text gets the language whose
prototype has the largest cosine with it.

Only letters matter: case is folded, everything else is a word's edge. Prototypes are
summed in each task and then by Spark, so a hot language costs one vector for each task;
what the driver holds is one vector for each language.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is
everything if nothing could be learned. Ties go to the first language by name. Training
rows need a text, a language and an id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.bpe import steps
from tidegate.llm.pretokens import LETTER, classes, code_points
from tidegate.llm.textkit import U64, Texts, mix

DIMENSIONS = 1024
#: Texts whose vectors are made together.
GROUP = 128
UNKNOWN = "und"


@lru_cache(maxsize=1 << 14)
def letter_vector(point: int, dimensions: int) -> np.ndarray:
    """Random signs that depend on the code point alone (0 is a word's edge)."""
    words = mix(np.arange(dimensions // 64, dtype=U64) * U64(0xD1342543DE82EF95) + U64(point + 1))
    return np.unpackbits(words.view(np.uint8)).astype(np.float32) * 2 - 1


@lru_cache(maxsize=1 << 16)
def folded(point: int) -> int:
    lower = chr(point).lower()
    return ord(lower) if len(lower) == 1 else point


class Grams:
    """Counts of the grams of each text: count[k] of gram code[k] in text[k], ordered by text."""

    def __init__(self, texts: Texts):
        lead, points = code_points(texts.buf)
        letter = classes(points) == LETTER
        n = len(points)
        opens = np.zeros(n + 1, bool)
        opens[np.searchsorted(lead, texts.start)] = True
        opens[n] = True
        at = np.flatnonzero(letter)
        used, index = np.unique(points[at], return_inverse=True) if len(at) < 64 else self._dense(points[at])
        lower = np.array([folded(int(p)) for p in used], np.int64)
        self.alphabet, to = np.unique(np.append(0, lower), return_inverse=True)
        code = np.zeros(n + 2, np.int64)  # one place before and after; 0 is an edge
        code[at + 1] = to[1:][index]
        size = len(self.alphabet)
        before = np.where(opens[at], 0, code[at])
        after = np.where(opens[at + 1], 0, code[at + 2])
        grams = (before * size + code[at + 1]) * size + after
        owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(lead[at], np.append(texts.start, len(texts.buf)))))
        packed = owner.astype(U64) * U64(size**3) + grams.astype(U64)
        packed.sort()
        new = np.ones(len(packed), bool)
        new[1:] = packed[1:] != packed[:-1]
        first = np.flatnonzero(new)
        self.count = np.diff(np.append(first, len(packed)))
        self.text = (packed[first] // U64(size**3)).astype(np.int64)
        self.code = (packed[first] % U64(size**3)).astype(np.int64)

    @staticmethod
    def _dense(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen = np.zeros(int(points.max()) + 1, bool)
        seen[points] = True
        return np.flatnonzero(seen), (np.cumsum(seen) - 1)[points]

    def vectors(self, codes: np.ndarray, dimensions: int) -> np.ndarray:
        size = len(self.alphabet)
        table = np.stack([letter_vector(int(p), dimensions) for p in self.alphabet])
        first, second = np.roll(table, 2, axis=1), np.roll(table, 1, axis=1)
        out = first[codes // size**2]
        out *= second[codes // size % size]
        out *= table[codes % size]
        return out


def _bundles(grams: Grams, n: int, dimensions: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of texts low.. in groups."""
    for low in range(0, n, GROUP):
        a, b = np.searchsorted(grams.text, [low, low + GROUP])
        size = min(GROUP, n - low)
        codes, index = np.unique(grams.code[a:b], return_inverse=True)
        counts = np.zeros((size, len(codes)), np.float32)
        counts[grams.text[a:b] - low, index] = grams.count[a:b]
        yield low, counts @ grams.vectors(codes, dimensions)


def train_profiles(docs: DataFrame, dimensions: int = DIMENSIONS, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """One prototype for each language of the rows that have a text and a language."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in steps(batch, "text"):
                grams = Grams(Texts(part.column("text")))
                if not len(grams.code):
                    continue
                langs = np.array(part.column("lang").to_pylist(), object)[grams.text]
                codes, index = np.unique(grams.code, return_inverse=True)
                names = sorted(set(langs))
                counts = np.stack([np.bincount(index[langs == x], weights=grams.count[langs == x], minlength=len(codes)) for x in names])
                for low in range(0, len(codes), 16 * GROUP):  # some vectors at a time
                    some = slice(low, low + 16 * GROUP)
                    for lang, bundle in zip(names, counts[:, some] @ grams.vectors(codes[some], dimensions), strict=True):
                        sums[lang] = sums.get(lang, 0) + bundle
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "bundle"]
        )

    parts = rows.mapInArrow(add_up, "lang string, bundle array<double>").select("lang", F.posexplode("bundle").alias("at", "value"))
    whole = parts.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    found = whole.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("bundle")).collect()
    return {r.lang: np.array([x.value for x in r.bundle]) for r in sorted(found, key=lambda r: r.lang)}


def identify(
    docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", passing: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, lang_pred and score, the cosine with the language's prototype (0 if negative).

    ``passing`` columns and, with any, the text go along unchanged, so that a filter needs no join.
    """
    langs = list(profiles)
    dimensions = len(profiles[langs[0]]) if langs else DIMENSIONS
    table = np.array([profiles[x] / max(np.linalg.norm(profiles[x]), 1e-300) for x in langs]).reshape(len(langs), dimensions)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                n = part.num_rows
                best, score = np.full(n, len(langs)), np.zeros(n)
                if langs:
                    grams = Grams(Texts(part.column("text")))
                    for low, bundles in _bundles(grams, n, dimensions):
                        bundles = bundles.astype(np.float64)
                        norm = np.sqrt((bundles**2).sum(axis=1))
                        cosine = (bundles @ table.T) / np.maximum(norm, 1e-300)[:, None]
                        top = cosine.argmax(axis=1)
                        best[low : low + len(top)] = np.where(norm > 0, top, len(langs))
                        score[low : low + len(top)] = np.clip(cosine[np.arange(len(top)), top], 0, 1)
                names = np.array([*langs, UNKNOWN], object)[best]
                arrays = [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), *(part.column(c) for c in along)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", *along])

    along = ["text", *passing] if passing else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *passing)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(predict, T.StructType(schema.fields + [rows.schema[c] for c in along]))


def held_out(id_col: str = "doc_id"):
    """Every fourth document by a checksum of its id is kept from training; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def trained_on(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
