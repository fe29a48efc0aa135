"""Operator 3: toxicity by a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: lower case, accents dropped, homoglyphs and digits or
signs that stand for letters replaced, everything else a space. A lexicon entry
is a whole word or the beginning of one. The entries, their weights and the
exception phrases, whose words do not count, are learned from labelled texts:
entries by greedy cover of the toxic texts among candidates that toxic texts
hold far more often, weights as log odds, exceptions as two-word phrases around
an entry that clean texts hold at least as often as toxic ones. The weight a
text collects, as a sum and per 100 words, becomes a score by a logistic
function fitted to the same texts.

At most ``max_toxic`` and ``max_clean`` labelled rows are used, those of
smallest hash of their doc_id. A row weighs as many labels as it stands for
(all of its kind over those chosen), so exceptions and the logistic function
follow the labels' true shares however large the corpus. Counts travel as sums
per task and the driver sees bounded lists only. Scoring covers every row and the whole text.

Defined cases: null and empty texts score as texts without entries; a document
labelled more than once is toxic if any label says so; labels without doc_id or
toxic are ignored; repeated rows are each scored; without labels of both kinds
every score is 0. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import ship, written

# What looks like which letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "ν": "v", "χ": "x", "ł": "l", "ø": "o", "đ": "d", "ı": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}


class _Folding(dict):
    """Table for str.translate: letters stay, marks go, all else is a space."""

    def __missing__(self, code: int):
        c = chr(code)
        kind = unicodedata.category(c)
        self[code] = None if kind == "Mn" else code if kind[0] in "LN" else " "
        return self[code]


_FOLDING = _Folding({ord(k): v for k, v in (HOMOGLYPHS | DIGITS).items()})


def fold(text: str | None) -> str:
    """Folded text: words parted by one space, one space at both ends; so phrases are met across any signs."""
    text = (text or "").casefold()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    return f" {' '.join(text.translate(_FOLDING).split())} "


@dataclass
class Lexicon:
    """``weights``: " word " or " beginning" -> weight. Picklable; the automaton is built per worker."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    logistic: tuple[float, ...] | None = None
    _automaton: object = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "logistic": self.logistic, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                machine.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                machine.add_word(phrase, (len(phrase), None))
            machine.make_automaton()
            self._automaton = machine
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight): per word the heaviest entry that no exception phrase holds."""
        if not self.weights:
            return []
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton().iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if excused:
            covered = {s for a, b in excused for s in range(a, b)}
            best = {s: w for s, w in best.items() if s not in covered}
        return list(best.items())

    def features(self, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        total = sum(w for _, w in self.hits(folded))
        words = max(1, len(folded.split())) if total else 1
        return np.log1p(total), np.log1p(100 * total / words)

    def score(self, text: str | None) -> float:
        if self.logistic is None:
            return 0.0
        a, b, c = self.logistic
        x, y = self.features(text)
        return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -30, 30))))


@dataclass(frozen=True)
class LexiconParams:
    max_toxic: int = 3000
    max_clean: int = 6000
    beginnings: tuple[int, ...] = (4, 5, 6)
    support: tuple[int, int] = (5, 8)  #: toxic texts an entry must newly cover: a hundredth of them, within these
    lift: float = 12.0  #: times as frequent in toxic texts as in clean ones
    max_candidates: int = 5000
    max_entries: int = 1000


def _candidates(folded: str, beginnings: tuple[int, ...]) -> set[str]:
    words = set(folded.split())
    out = {f" {w} " for w in words}
    for n in beginnings:
        out |= {f" {w[:n]}" for w in words if len(w) >= n}
    return out


def _sketch(folded: str) -> int:
    """The same for most near copies: from the three words of smallest hash."""
    words = sorted({zlib.crc32(w.encode()) for w in folded.split()})[:3]
    return hash(tuple(words))


def sample(docs: DataFrame, labels: DataFrame, params: LexiconParams) -> DataFrame:
    """text, toxic, weight of a bounded number of labelled rows, written once."""
    marks = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    )
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def some(side: bool, most: int) -> DataFrame:
        weight = max(1.0, totals.get(side, 0) / most)
        return marks.where(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("weight", F.lit(weight))

    chosen = some(True, params.max_toxic).unionByName(some(False, params.max_clean))
    texts = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    return written(texts.dropDuplicates(["doc_id"]).select("text", "toxic", "weight"), "toxicity_sample")


def learn(texts: DataFrame, params: LexiconParams = LexiconParams()) -> Lexicon:
    """A lexicon from rows (text, toxic) and their ``weight``, 1 if there is no such column."""
    if "weight" not in texts.columns:
        texts = texts.withColumn("weight", F.lit(1.0))
    ship(texts.sparkSession)
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return Lexicon()

    support = max(params.support[0], min(params.support[1], n_toxic // 100))

    def count(batches: Iterator) -> Iterator:
        import pandas as pd

        seen = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen[bool(toxic)].update(_candidates(fold(text), params.beginnings))
        entries = list(seen[True].keys() | seen[False].keys())
        yield pd.DataFrame({"entry": entries, "toxic": [seen[True][e] for e in entries], "clean": [seen[False][e] for e in entries]})

    lift = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    found = (
        texts.mapInPandas(count, "entry string, toxic long, clean long")
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= support) & (lift >= params.lift))
        .orderBy(F.desc("toxic"), F.length("entry"), "entry").limit(params.max_candidates).collect()
    )
    odds = {r["entry"]: float(np.log((r["toxic"] + 0.5) / (n_toxic + 1)) - np.log((r["clean"] + 0.5) / (n_clean + 1))) for r in found}

    def holds(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            folded = [fold(t) for t in batch["text"][batch["toxic"].astype(bool)]]
            yield pd.DataFrame({
                "sketch": [_sketch(t) for t in folded],
                "entries": [sorted(_candidates(t, params.beginnings) & odds.keys()) for t in folded],
            })

    # At most max_toxic lists of entries out of max_candidates. Near copies
    # count as one text, or their chance words would look like entries.
    by_sketch: dict[int, set[str]] = {}
    for r in texts.where("toxic").mapInPandas(holds, "sketch long, entries array<string>").collect():
        by_sketch.setdefault(r["sketch"], set()).update(r["entries"])
    held = list(by_sketch.values())
    lexicon = Lexicon({e: odds[e] for e in greedy_cover(held, odds, support, params.max_entries)})
    lexicon.exceptions = _exceptions(texts, lexicon)
    lexicon.logistic = _fit(texts, lexicon)
    return lexicon


def greedy_cover(held: list[set[str]], odds: dict[str, float], support: int, max_entries: int) -> list[str]:
    """Entries that each cover ``support`` more texts than those before, most odds covered first."""
    by_entry: dict[str, set[int]] = {}
    for i, entries in enumerate(held):
        for e in entries:
            by_entry.setdefault(e, set()).add(i)
    out: list[str] = []
    # A text counts twice before it is covered: it often holds several entries.
    need = Counter({i: 2 for i in range(len(held))})
    while by_entry and len(out) < max_entries:
        gain = {e: sum(1 for i in texts if need[i] > 0) for e, texts in by_entry.items()}
        best = min(gain, key=lambda e: (-gain[e] * odds[e], len(e), e))
        if gain[best] < support:
            break
        out.append(best)
        for i in by_entry.pop(best):
            need[i] -= 1
        stem = best.rstrip(" ")
        by_entry = {e: t for e, t in by_entry.items() if gain[e] >= support and not e.startswith(stem)}
    return out


def _exceptions(texts: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases around an entry that clean texts hold as often as toxic ones."""

    def phrases(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = set()
            for n, (text, toxic, weight) in enumerate(zip(batch["text"], batch["toxic"], batch["weight"], strict=True)):
                folded = fold(text) if lexicon.weights else " "
                for start, _ in lexicon.hits(folded):
                    end = folded.find(" ", start + 1)
                    left, right = folded.rfind(" ", 0, start), folded.find(" ", end + 1)
                    if left >= 0:
                        rows.add((n, folded[left : end + 1], bool(toxic), weight))
                    if right >= 0:
                        rows.add((n, folded[start : right + 1], bool(toxic), weight))
            yield pd.DataFrame([r[1:] for r in rows], columns=["phrase", "toxic", "weight"])

    got = (
        texts.mapInPandas(phrases, "phrase string, toxic boolean, weight double").groupBy("phrase")
        .agg(F.sum(F.when(F.col("toxic"), -F.col("weight")).otherwise(F.col("weight"))).alias("excess"), F.count_if(~F.col("toxic")).alias("clean"))
        .where((F.col("clean") >= 3) & (F.col("excess") >= 0)).orderBy(F.desc("clean"), "phrase").limit(1000).collect()
    )
    return [r["phrase"] for r in got]


def _fit(texts: DataFrame, lexicon: Lexicon) -> tuple[float, ...]:
    """Logistic regression of the label on the two features, rows by weight, by Newton steps."""

    def measure(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = [lexicon.features(t) for t in batch["text"]]
            yield pd.DataFrame({"x": [r[0] for r in rows], "y": [r[1] for r in rows], "toxic": batch["toxic"].to_numpy(dtype=float), "weight": batch["weight"]})

    rows = np.array([tuple(r) for r in texts.mapInPandas(measure, "x double, y double, toxic double, weight double").collect()])
    x = np.column_stack([np.ones(len(rows)), rows[:, 0], rows[:, 1]])
    w, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T * (rows[:, 3] * p * (1 - p)) @ x + ridge, x.T @ (rows[:, 3] * (rows[:, 2] - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score of every row of ``docs``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def rate(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch[["doc_id"]].assign(score=[shared.value.score(t) for t in batch["text"]])

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInPandas(rate, f"doc_id {kind}, score double")
