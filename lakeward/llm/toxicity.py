"""Toxicity by a subsequence string kernel with Nyström landmarks.

The kernel counts common subsequences of three characters, each weighted by how far it
is spread in either string, so a word still resembles an insult after letters were put in
between or endings changed. It is normalised (a string's value with itself is 1) and raised
to a power, which keeps it a kernel; the same kernel fills the landmarks' own matrix and the
features. Landmarks are pieces of labelled toxic sentences that repeat on other labelled
rows, and words of labelled clean sentences that come close to them. A word's features are
its kernel values mapped by the inverse root of the landmarks' matrix; a linear support
vector machine on them is trained on the words of labelled sentences, a toxic text being known by
its worst words. A text is scored by the sum of its words' values and by its length, as a long
text holds a word like an insult by chance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Labelled rows that the model is fitted on, at most, of either label.
TOXIC_ROWS, CLEAN_ROWS = 900, 1600
#: Landmarks from toxic and from clean sentences.
LANDMARKS, CLEAN_LANDMARKS = 32, 16
DECAY = 0.6
#: The normalised kernel is raised to this power. POWER and SHARE are the best of five settings in a four-fold
#: cross-validation on labelled rows that are not held out.
POWER = 3
THRESHOLD = 0.7
#: Longer words are read in windows of this many characters, half overlapping.
WINDOW = 24
#: Weight of the squared norm against the loss of a row.
RIDGE = 1e-3
#: Rounds in which the worst words of each toxic text are chosen anew: those with this share of its worst one's value.
ROUNDS, SHARE = 4, 0.5
#: Kernel values below this count as none in training.
FAINT = 0.02
#: Remembered words per Python worker.
REMEMBERED = 1_000_000

WORDS = re.compile(r"\b\w(?:\s\w){2,}\b|\w+(?:[^\w\s]+\w+)*")
INNER = re.compile(r"[\W_]+")
DIGITS = str.maketrans("013457", "oieast")


def words_of(text: str) -> set[str]:
    """Distinct words in lower case; single letters in a row are one word."""
    return set(WORDS.findall(text.lower()))


def normal(word: str) -> str:
    """Without inner signs, digits read as the letters they resemble, ends marked."""
    if not word.isalpha():
        word = INNER.sub("", word)
        if not word.isdigit():
            word = word.translate(DIGITS)
    return f"^{word}$"


def windows(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def _codes(strings: list[str]) -> np.ndarray:
    width = max(map(len, strings), default=1) or 1
    out = np.zeros((len(strings), width), np.int32)
    for k, s in enumerate(strings):
        out[k, : len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<i4")
    return out


def kernel(left: list[str], right: list[str], decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of order 3 between all of left and all of right."""
    s, t = _codes(left), _codes(right)
    n, m, width = len(left), len(right), t.shape[1]
    letters = np.unique(t[t > 0])
    at = np.searchsorted(letters, s)
    at = np.where((s > 0) & (letters[np.minimum(at, len(letters) - 1)] == s), at, len(letters)) if len(letters) else np.zeros_like(s)
    stands = np.zeros((width, len(letters) + 1, m), np.float32)  # which places of right hold a letter
    for k, c in enumerate(letters):
        stands[:, k] = (t == c).T
    two = np.float32(decay * decay)
    stands *= two
    near = np.zeros((2, width + 1, n, m), np.float32)  # orders 1 and 2, up to the place before
    total = np.zeros((n, m), np.float32)
    run = np.zeros((2, n, m), np.float32)
    for i in range(s.shape[1]):
        one = stands.take(at[:, i], axis=1)
        total += (one * near[1, :-1]).sum(0)
        second = one * near[0, :-1]
        near *= np.float32(decay)
        run[:] = 0
        for j in range(width):
            run *= np.float32(decay)
            run[0] += one[j]
            run[1] += second[j]
            near[:, j + 1] += run
    return total


def paired(strings: list[str], decay: float = DECAY) -> np.ndarray:
    """Each string's kernel value with itself."""
    s = _codes(strings)
    n, width = s.shape
    near, total = np.zeros((2, width + 1, n), np.float32), np.zeros(n, np.float32)
    two, run = np.float32(decay * decay), np.zeros((2, n), np.float32)
    for i in range(width):
        one = two * ((s == s[:, i, None]) & (s > 0)).T.astype(np.float32)
        total += (one * near[1, :-1]).sum(0)
        second = one * near[0, :-1]
        near *= np.float32(decay)
        run[:] = 0
        for j in range(width):
            run *= np.float32(decay)
            run[0] += one[j]
            run[1] += second[j]
            near[:, j + 1] += run
    return total


def likeness(left: list[str], right: list[str], own: np.ndarray | None = None) -> np.ndarray:
    """The kernel that everything here uses: normalised, to the power POWER, in [0, 1]."""
    own = paired(right) if own is None else own
    norm = np.sqrt(np.outer(paired(left), own))
    return np.where(norm > 0, np.minimum(kernel(left, right) / np.where(norm > 0, norm, 1), 1), 0) ** POWER


@dataclass(frozen=True)
class Model:
    """weights act on kernel values (the Nyström map is folded in)."""

    landmarks: tuple[str, ...] = ()
    weights: tuple[float, ...] = ()
    bias: float = 0.0
    own: tuple[float, ...] = ()
    #: For the sum of the words' values, the number of words and nothing.
    text_weights: tuple[float, float, float] = (1.0, 0.0, -20.0)

    def values(self, words: list[str]) -> np.ndarray:
        """Per word its distance on the toxic side, 1 at most and 0 on the clean side; a long
        word's is that of its worst window."""
        out = np.zeros(len(words))
        parts = [(w, k) for k, word in enumerate(words) for w in windows(word)]
        parts.sort(key=lambda x: len(x[0]))
        own, weights = np.array(self.own, np.float32), np.array(self.weights)
        for at in range(0, len(parts), 512):
            some = parts[at : at + 512]
            margin = likeness([w for w, _ in some], list(self.landmarks), own) @ weights + self.bias
            np.maximum.at(out, [k for _, k in some], np.clip(margin, 0, 1))
        return out

    def score(self, total: float, n: int) -> float:
        at = float(np.dot(self.text_weights, described(np.array([total]), np.array([n]))[0]))
        return float(1 / (1 + np.exp(-np.clip(at, -40, 40))))


def described(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What a text is scored by: logarithms of its words' values and of their number."""
    return np.c_[np.log1p(total), np.log1p(n), np.ones(len(n))]


class Scorer:
    """Scores texts; remembers words and the values of those that have one."""

    def __init__(self, model: Model):
        self.model = model
        self.known: set[str] = set()
        self.worse: dict[str, float] = {}

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of its distinct words' values, and their number."""
        known, worse = self.known, self.worse
        words = [words_of(t) for t in texts]
        if len(known) > REMEMBERED:
            known.clear()
            worse.clear()
        new = [*(set().union(*words) - known)]
        known.update(new)
        for w, v in zip(new, self.model.values([normal(w) for w in new]), strict=True):
            if v > 0:
                worse[w] = float(v)
        return np.array([sum(sorted(worse[w] for w in some & worse.keys())) for some in words], float), np.array([*map(len, words)])

    def scores(self, texts: list[str], block: int = 64) -> list[float]:
        if not self.model.landmarks:
            return [0.0] * len(texts)
        return [self.model.score(v, n) for at in range(0, len(texts), block) for v, n in zip(*self.totals(texts[at : at + block]), strict=True)]


@lru_cache(maxsize=2)
def scorer(model: Model) -> Scorer:
    """One per Python worker, kept from task to task."""
    return Scorer(model)


def _pieces(word: str) -> set[str]:
    """Pieces of 5 to 9 characters, of each window of a long word."""
    return {w[i : i + n] for w in windows(word) for n in (5, 6, 7, 8, 9) for i in range(len(w) - n + 1)}


#: Counters that tell which pieces are too rare to be looked at.
COUNTERS = 1 << 22


def _by_word(texts: list[set[str]]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for k, words in enumerate(texts):
        for w in words:
            out.setdefault(w, []).append(k)
    return out


def _holders(texts: list[set[str]], least: int) -> dict[str, set[int]]:
    """Piece to the texts that hold it, for pieces of at least so many texts. Counters of a fixed
    number first drop most of the others, whose sets would fill the driver's memory."""
    words, counts = _by_word(texts), np.zeros(COUNTERS, np.int32)
    spot = lambda x: zlib.crc32(x.encode("utf-8", "surrogatepass")) % COUNTERS
    for w, held in words.items():
        for x in _pieces(w):
            counts[spot(x)] += len(held)
    out: dict[str, set[int]] = {}
    for w, held in words.items():
        for x in _pieces(w):
            if counts[spot(x)] >= least:
                out.setdefault(x, set()).update(held)
    return {x: held for x, held in out.items() if len(held) >= least}


def _counted(texts: list[set[str]], pieces: set[str]) -> Counter[str]:
    """In how many texts each of the pieces stands, counted by words: at least that."""
    out: Counter[str] = Counter()
    for w, held in _by_word(texts).items():
        for x in _pieces(w) & pieces:
            out[x] += len(held)
    return out


def pick_landmarks(toxic: list[set[str]], clean: list[set[str]], most: int = LANDMARKS) -> list[str]:
    """Pieces of toxic texts that clean ones hardly have, one by one; a text counts less for
    every landmark it already has. Every other text is kept back: a piece has to be
    as telling there, which drops those that are noise."""
    scale = len(toxic) / len(clean)
    least = max(2, len(toxic) // 150)
    halves = [{x: np.array([*held]) for x, held in _holders(toxic[k::2], least).items()} for k in (0, 1)]
    both = halves[0].keys() & halves[1].keys()
    other = [_counted(clean[k::2], both) for k in (0, 1)]
    telling = {x for x in both if all(other[k][x] * scale <= 0.05 * len(halves[k][x]) for k in (0, 1))}
    ids = {x: np.r_[2 * halves[0][x], 2 * halves[1][x] + 1] for x in telling}
    weight, out = np.ones(len(toxic)), []
    while ids and len(out) < most:
        gain = {x: float(weight[i].sum()) for x, i in ids.items()}
        best = max(gain, key=lambda x: (gain[x], x))
        if gain[best] < least:
            break
        full = max((x for x in ids if best in x and len(ids[x]) >= 0.97 * len(ids[best])), key=lambda x: (len(x), len(ids[x]), x))
        out.append(full)
        weight[ids[best]] *= 0.6
        near = {full[i : i + 3] for i in range(len(full) - 2)}
        ids = {x: i for x, i in ids.items() if sum(x[j : j + 3] in near for j in range(len(x) - 2)) < 2}
    return out


def separate(x: np.ndarray, y: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge, Newton steps)."""
    z = np.c_[x, np.ones(len(y))]
    v = np.zeros(z.shape[1])
    ridge = np.diag(np.r_[np.full(x.shape[1], RIDGE), 1e-6]) * per.sum()
    for _ in range(50):
        on = y * (z @ v) < 1
        a = z[on] * per[on, None]
        step = np.linalg.solve(a.T @ z[on] + ridge, a.T @ y[on])
        if np.abs(step - v).max() < 1e-9:
            break
        v = 0.5 * v + 0.5 * step
    return v[:-1], float(v[-1])


def calibrate(x: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic curve on x, with Platt's softened aims."""
    aim = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    v = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        h = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * h[:, None]).T @ x + 1e-3 * np.eye(len(v)), x.T @ (p - aim) + 1e-3 * v)
        v = v - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(a) for a in v)


def train(toxic: list[str], clean: list[str], most: int = LANDMARKS) -> Model:
    """The machine learns from words: all of clean texts against the worst ones of each toxic
    text, chosen anew in ROUNDS rounds; toxic texts without a word that resembles a landmark
    are left out. If either label or every landmark is missing, the model scores every text 0."""
    bad = [{normal(w) for w in words_of(t)} for t in toxic]
    good = [{normal(w) for w in words_of(t)} for t in clean]
    found = pick_landmarks(bad, good, most) if bad and good else []
    if not found:
        return Model()
    calm = [w for w, _ in sorted(Counter(w for t in good for w in t).items(), key=lambda x: (-x[1], x[0])) if len(w) <= WINDOW]
    close = np.concatenate([likeness(calm[at : at + 4096], found).max(1) for at in range(0, len(calm), 4096)])
    landmarks = found + [calm[k] for k in np.argsort(-close, kind="stable")[:CLEAN_LANDMARKS]]
    own = paired(landmarks)
    values, vectors = np.linalg.eigh(likeness(landmarks, landmarks, own))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    # words under FAINT are one point, the origin, that stands for all of them
    every = sorted({w for t in bad for w in t if len(w) <= WINDOW} | set(calm))
    raw, place = [], {}
    for at in range(0, len(every), 4096):
        some = likeness(every[at : at + 4096], landmarks, own)
        for k in np.flatnonzero(some.max(1) >= FAINT):
            place[every[at + k]] = len(raw)
            raw.append(some[k])
    raw = np.array(raw)
    mapped = raw @ root
    texts = [np.array([place[w] for w in t if w in place], int) for t in bad]
    texts = [t for t in texts if len(t) and raw[t, : len(found)].max() > 0.1]
    known = np.array([place[w] for w in calm if w in place], int)
    value, w, b = raw[:, : len(found)].max(1), np.zeros(len(landmarks)), 0.0
    for _ in range(ROUNDS if texts else 0):
        worst = np.concatenate([t[value[t] >= SHARE * value[t].max()] for t in texts])
        x = np.concatenate([mapped[worst], mapped[known], np.zeros((1, len(landmarks)))])
        y = np.r_[np.ones(len(worst)), -np.ones(len(known) + 1)]
        per = np.r_[np.full(len(worst), 0.5 / len(worst)), np.full(len(known), 0.5 / len(calm)), 0.5 * (len(calm) - len(known)) / len(calm)]
        w, b = separate(x, y, per)
        value = np.maximum(mapped @ w + b + 1, 0)
    draft = Model(tuple(landmarks), tuple(float(v) for v in root @ w), b, tuple(float(v) for v in own))
    at = described(*Scorer(draft).totals([*toxic, *clean]))
    return replace(draft, text_weights=calibrate(at, np.arange(len(at)) < len(toxic)))


def training_texts(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str]]:
    """Texts of at most TOXIC_ROWS and CLEAN_ROWS labelled rows outside the held-out
    third, those with the smallest checksums of their ids, one text an id. The ids are few
    enough to send to every executor, so the documents are read once and not shuffled."""
    mine = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~is_held_out("doc_id"))
    order = [F.crc32(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    some = mine.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS).unionByName(mine.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    texts = docs.join(F.broadcast(some), "doc_id").where("text is not null").groupBy("doc_id", "toxic").agg(F.min(F.col("text").cast("string")).alias("text"))
    rows = texts.collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return [r.text for r in rows if r.toxic == 1], [r.text for r in rows if r.toxic == 0]


def is_held_out(column: str):
    """The third that is never learnt from; a null id is not in it."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted).

    Null and empty texts have no words and score what the bias gives; repeated rows
    score alike; null ids are kept; an empty table gives an empty result; other
    columns are dropped. Every word of a text counts, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = scorer(model).scores
        for batch in batches:
            scores = read([t.as_py() or "" for t in batch.column(2)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    return (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "doc_id bigint, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(*training_texts(docs, table(spark, sf_dir, "labels"))))
