"""Language identification by cross-parsing: the language whose labelled text covers a text with the fewest phrases wins."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import join_small, materialize, pieces

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Words kept with their phrase counts in each worker; the store is emptied when it is full.
STORE = 300_000
LONGEST_STORED = 48


def words_of(text: str) -> list[str]:
    """The runs of letters in lower case. The pattern lets other number characters pass (fractions, superscripts); they are cut out."""
    found = LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for word in found for part in "".join(c if c.isalpha() else " " for c in word).split()]


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of a text: state 0 accepts exactly its substrings."""
    steps: list[dict[str, int]] = [{}]
    links, longest, last = [-1], [0], 0
    for letter in text:
        fresh = len(steps)
        steps.append({})
        longest.append(longest[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and letter not in steps[at]:
            steps[at][letter] = fresh
            at = links[at]
        if at >= 0:
            target = steps[at][letter]
            if longest[at] + 1 == longest[target]:
                links[fresh] = target
            else:
                clone = len(steps)
                steps.append(dict(steps[target]))
                longest.append(longest[at] + 1)
                links.append(links[target])
                while at >= 0 and steps[at].get(letter) == target:
                    steps[at][letter] = clone
                    at = links[at]
                links[target] = links[fresh] = clone
        last = fresh
    return steps


def phrases(steps: list[dict[str, int]], text: str) -> int:
    """Greedy longest matches that cover a text; a letter unknown to the language is a phrase of its own."""
    count, state = 0, 0
    for letter in text:
        following = steps[state].get(letter)
        if following is None:
            if state:
                count += 1
            following = steps[0].get(letter)
            if following is None:
                count += 1
                following = 0
        state = following
    return count + (state > 0)


class Parser:
    """The automata of all languages, with the phrase counts of words met before."""

    def __init__(self, samples: list[tuple[str, str]]):
        self.languages = [name for name, _ in samples]
        self.steps = [automaton(text) for _, text in samples]
        self.scale = np.array([math.log2(len(text) + 2) for _, text in samples])
        self.known: dict[str, int] = {}
        self.counts = np.zeros((STORE + 1, len(samples)), dtype=np.uint16)

    def parse(self, word: str) -> list[int]:
        return [phrases(steps, f" {word} ") for steps in self.steps]

    def place(self, word: str) -> int:
        at = len(self.known)
        self.known[word] = at
        self.counts[at] = self.parse(word)
        return at

    def bits(self, text: str) -> tuple[np.ndarray | None, int]:
        """Normalised phrases per letter for each language, and the number of letters."""
        words = words_of(text)
        if not words:
            return None, 0
        total = np.zeros(len(self.languages), dtype=np.int64)
        letters = sum(map(len, words))
        for first in range(0, len(words), 65_536):
            part = words[first : first + 65_536]
            if len(self.known) + len(part) > STORE:
                self.known.clear()
            places = [self.known.get(w, -1) for w in part]
            for at, (word, place) in enumerate(zip(part, places)):
                if place < 0:
                    if len(word) > LONGEST_STORED:
                        total += self.parse(word)
                        places[at] = STORE
                    else:
                        places[at] = self.known[word] if word in self.known else self.place(word)
            total += self.counts[places].sum(axis=0, dtype=np.int64)
        return total * self.scale / letters, letters

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text:
            return UNKNOWN, 0.0
        bits, letters = self.bits(text)
        if not letters:
            return UNKNOWN, 0.0
        order = np.argsort(bits, kind="stable")
        best = bits[order[0]]
        if len(order) == 1:
            return self.languages[order[0]], 1.0
        return self.languages[order[0]], float(min(1.0, max(0.0, 1.0 - best / bits[order[1]])))


_PARSERS: dict[str, Parser] = {}


def parser_for(samples: list[tuple[str, str]]) -> Parser:
    """One parser per worker process and model."""
    mark = hashlib.md5(repr(samples).encode()).hexdigest()
    if mark not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[mark] = Parser(samples)
    return _PARSERS[mark]


def training_samples(labelled: DataFrame, key: str, text: str, lang: str, sample_chars: int, doc_chars: int) -> list[tuple[str, str]]:
    """(language, text) of at most `sample_chars` characters each, from documents in the order of a hash of their key.

    The only bounded sample of the operator, as its two parameters say: `doc_chars` of a document, `sample_chars` of a
    language. Language sizes are counted first, so that about four times the need leaves the tasks, never a whole language.
    """
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    piece = F.substring(F.col(text), 1, doc_chars)
    rows = usable.select(F.col(lang).alias("lang"), piece.alias("piece"), F.xxhash64(F.col(key), piece).alias("h"))
    sizes = rows.groupBy("lang").agg(F.sum(F.length("piece")).alias("chars"), F.count("*").alias("n"))
    share = sizes.select("lang", F.least(F.lit(1.0), (F.lit(4.0 * sample_chars) + 16 * doc_chars) / F.col("chars")).alias("share"))
    picked = join_small(rows, materialize(share, "language-shares"), "lang").where((F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) < F.col("share"))
    by_lang: dict[str, list] = {}
    order = Window.partitionBy("lang").orderBy("h", "piece").rowsBetween(Window.unboundedPreceding, -1)
    bounded = picked.withColumn("before", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0))).where(F.col("before") < sample_chars)
    for row in bounded.select("lang", "piece", "before").orderBy("lang", "before", "piece").collect():
        by_lang.setdefault(row["lang"], []).append(row["piece"])
    return [(name, " ".join(["", *words_of(" ".join(by_lang[name]))])[:sample_chars] + " ") for name in sorted(by_lang)]


def identify_languages(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_chars: int = 40_000, doc_chars: int = 4_000, label_text: str | None = None) -> DataFrame:
    """All rows and columns of `docs` with lang_pred and lang_score.

    Suffix automata are built in each worker from the bounded samples of `labelled`. A text is parsed word by word (its
    letters in lower case, one blank around each word) into longest matches; phrases times log2 of the sample's length,
    per letter, are the bits a language needs. The least wins, ties go to the smaller name; the score is
    1 - least / second least, 1 for a single language. Texts that are NULL or without a letter, and all texts when nothing is
    labelled, are `und` with score 0. Only the text is used. Repeated rows are judged alike; the two new columns replace
    columns of the same name. Nothing is shuffled but the sample.
    """
    samples = training_samples(labelled, key, label_text or text, lang, sample_chars, doc_chars)
    sent = docs.sparkSession.sparkContext.broadcast(samples)
    rows = docs.drop("lang_pred", "lang_score")
    names = rows.columns
    place = names.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_for(sent.value)
        for batch in pieces(batches):
            found = [parser.predict(t) for t in batch.column(place).to_pylist()]
            extra = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*names, "lang_pred", "lang_score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return rows.mapInArrow(judge, schema)


def keep_identified(docs: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """The rows of `docs` that get a language, with their columns; where `lang` is NULL it becomes the language found, a given
    one stays. Texts without a letter are rejected; when no labelled text exists no language can be told, and every text
    with a letter stays as it is. Without a column `lang` only rows are chosen."""
    taught = not labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).isEmpty()
    if not taught:
        return docs.where(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    renamed = docs.withColumnsRenamed({c: f"tw_{c}" for c in docs.columns})
    found = identify_languages(renamed, labelled, text=f"tw_{text}", lang=lang, label_text=text, **options).where(F.col("lang_pred") != UNKNOWN)
    return found.select(*[(F.coalesce(f"`tw_{c}`", "lang_pred") if c == lang else F.col(f"`tw_{c}`")).alias(c) for c in docs.columns])


def held_out(key: str = "doc_id") -> Column:
    """The fold that is never learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
