"""Language by two steps: the family first, then pairwise linear support vector machines in it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import DROP, map_rows, rewrite_text

SIZE = 2048  # hashed features
SAMPLE = 3000  # training documents at most, dealt evenly over the languages
LANGUAGES = 1000  # different labels at most; more are refused
ROUNDS = 150
SHARPNESS = 4.0
LEAST = 0.3  # documents under this score are rejected by the filter
UNKNOWN = "und"

# Families of languages by code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt am",
    "indic": "hi bn ur pa gu mr ne",
    "iranian": "fa ku ps",
    "celtic": "ga cy br gd",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = re.compile(r"[^\W\d_]")  # or a number sign such as ½
_OTHER = re.compile(r"[\W\d_]+")


def lettered(text: str) -> bool:
    """Whether there is a letter in it."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def family(code: str) -> str:
    return _FAMILY.get(code.lower().split("-")[0], "other")


def features(text: str) -> np.ndarray:
    """Square roots of counts of hashed letter triples over the whole text, at unit length."""
    raw = np.frombuffer((" " + _OTHER.sub(" ", text.lower()) + " ").encode(), np.uint8)
    counts = np.zeros(SIZE, np.int64)
    for start in range(0, max(1, len(raw) - 2), 1 << 20):
        part = raw[start : start + (1 << 20) + 2].astype(np.uint32)
        code = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(21), minlength=SIZE)
    out = np.sqrt(counts, dtype=np.float32)
    return out / max(float(np.linalg.norm(out)), 1e-9)


def machine(x: np.ndarray, positive: np.ndarray, rounds: int = ROUNDS, decay: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine, classes weighed alike.

    Sub-gradient steps over all rows, averaged; nothing is random.
    """
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w, mean = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    for t in range(1, rounds + 1):
        open_rows = (y * (x @ w[:-1] + w[-1]) < 1) * y * share
        step = np.append(x.T @ open_rows, open_rows.sum()) - decay * w
        w = w + 20 / np.sqrt(t) * step
        mean += w
    return mean / rounds


@dataclass
class Model:
    """Weights by family and by pair of languages within one."""

    families: dict[str, list[str]] = field(default_factory=dict)
    apart: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score from 0 to 1 of each text; ``und`` with 0 without any letter."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and lettered(t)]
        if not rows or not self.families:
            return out
        x = np.stack([features(texts[i]) for i in rows])
        names = list(self.families)
        if len(names) > 1:
            m = SHARPNESS * np.stack([x @ self.apart[f][:-1] + self.apart[f][-1] for f in names])
            m = np.exp(m - m.max(axis=0))
            chance = m / m.sum(axis=0)
        else:
            chance = np.ones((1, len(rows)))
        first = chance.argmax(axis=0)
        for k, f in enumerate(names):
            mine = np.nonzero(first == k)[0]
            if not len(mine):
                continue
            codes = self.families[f]
            wins = {c: np.zeros(len(mine)) for c in codes}
            for a, b in combinations(codes, 2):
                w = self.pairs[a, b]
                p = 1 / (1 + np.exp(-SHARPNESS * (x[mine] @ w[:-1] + w[-1])))
                wins[a] += p
                wins[b] += 1 - p
            table = np.stack([wins[c] / max(1, len(codes) - 1) if len(codes) > 1 else wins[c] + 1 for c in codes])
            best = table.argmax(axis=0)
            for j, i in enumerate(mine):
                out[rows[i]] = (codes[best[j]], float(min(1.0, table[best[j], j] * chance[k, i])))
        return out


def train(x: np.ndarray, labels: list[str]) -> Model:
    held = np.array(labels)
    families: dict[str, list[str]] = {}
    for code in sorted(set(labels)):
        families.setdefault(family(code), []).append(code)
    names = np.array([family(c) for c in labels])
    apart = {f: machine(x, names == f) for f in families} if len(families) > 1 else {}
    pairs = {}
    for codes in families.values():
        for a, b in combinations(codes, 2):
            mine = (held == a) | (held == b)
            pairs[a, b] = machine(x[mine], held[mine] == a)
    return Model(families, apart, pairs)


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training; one without an id always is."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def fit(docs: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """Learn from labelled documents outside the held-out share.

    All labels are counted; of each language, rows whose hash falls under its share of ``sample``
    are taken, so about ``sample`` documents reach the driver as ``SIZE`` numbers each, however
    many there are. No labels, or one language, give a model that says so.
    """
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
    counts = known.groupBy(F.col(label).alias("c")).count().limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different labels")
    if not counts:
        return Model()
    each = max(1, sample // len(counts))
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["c"], min(1.0, each / r["count"]))])
    spot = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    taken = known.where(spot < share[F.col(label)]).select(F.col(text), F.col(label))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for t, c in rows:
            if lettered(t):
                yield features(t).tobytes(), c

    rows = map_rows(taken, work, "x binary, c string").limit(2 * sample).collect()
    if not rows:
        return Model()
    rows.sort(key=lambda r: (r["c"], bytes(r["x"])))
    return train(np.stack([np.frombuffer(r["x"], np.float32) for r in rows]), [r["c"] for r in rows])


def _in_batches(rows: Iterator[tuple], model: Model) -> Iterator[tuple]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 256:
            yield from (r[:-1] + p for r, p in zip(held, model.predict([r[-1] for r in held]), strict=True))
            held = []
    yield from (r[:-1] + p for r, p in zip(held, model.predict([r[-1] for r in held]), strict=True))


def identify(docs: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text",
             label: str = "lang") -> DataFrame:
    """Language of every document: ``doc_id, held_out, lang_pred, score``.

    NULL texts and texts without letters are ``und`` with score 0, as is everything when nothing
    was learned. Only the text decides. Repeated rows are predicted alike; other columns are not
    read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, key, text, label))
    kind = docs.schema[key].dataType.simpleString()
    return map_rows(
        docs.select(F.col(key), held_out(key).alias("h"), F.col(text)),
        lambda rows: _in_batches(rows, model.value),
        f"`{key}` {kind}, held_out boolean, lang_pred string, score double",
    )


def keep_identified(docs: DataFrame, least: float = LEAST, sample: int = SAMPLE, key: str = "doc_id",
                    text: str = "text", label: str = "lang") -> DataFrame:
    """Documents whose language is told with at least this score; all columns stay as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, key, text, label))

    def work(lists: Iterator[list]) -> Iterator[list]:
        for texts in lists:
            found = model.value.predict(texts)
            yield [t if c != UNKNOWN and s >= least else DROP for t, (c, s) in zip(texts, found, strict=True)]

    return rewrite_text(docs, work, text)
