"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's evidence is its own features and those of the lines before and
after it; neighbouring labels are tied by transition weights. Marginals come from forward-backward in log space, run for
many documents side by side, and a document's quality is their mean weighted by line length, put through a logistic
calibration. Labels exist for documents only: in training each line bears its document's label. The weights are fitted
by gradient on a bounded sample of labelled documents (SAMPLE a class, TRAIN_LINES lines in a row of each), features
computed on executors. Scoring reads every line of every text, in blocks.

Defined cases: a null or empty text is one empty line; a label row with a null or another value than 0 or 1 is ignored;
of labels repeated for a document each counts; without labels of both kinds every score is 0.5; repeated rows give equal
rows; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fold, map_column, table

#: Labelled documents a class that training reads, and lines of each at most.
SAMPLE, TRAIN_LINES = 1500, 96
STEPS, RATE, DECAY = 250, 0.05, 1e-3
#: Documents whose features are made at once in training; lines and characters of a block; bytes that are counted at a time.
GROUP, LINES, CHARACTERS, PIECE = 100, 20_000, 1 << 20, 1 << 20
#: Texts that go side by side at least.
FEW = 8

_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b".", b",;:", b"!?", b"|", b"#$%&*+/<=>@\\^_`{}~", b"\"'()-[]"]
_OTHER, _N = len(_CLASSES), len(_CLASSES) + 2
_CLASS = np.full(256, _OTHER, np.int64)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS[list(_bytes)] = _k
_CLASS[128:] = _OTHER + 1
#: Features of a line by itself; with its neighbours' and their absence a line has three times as many and two.
OWN = 2 * _N + 7


def _class_counts(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes of each class in each of the lines that flat holds end to end; memory is bounded by PIECE."""
    ends = np.cumsum(lengths)
    starts, count = ends - lengths, np.zeros((len(lengths), _N), np.int64)
    for low in range(0, len(flat), PIECE):
        high = min(low + PIECE, len(flat))
        first, last = np.searchsorted(ends, [low, high - 1], side="right")
        here = np.minimum(ends[first : last + 1], high) - np.maximum(starts[first : last + 1], low)
        of = np.repeat(np.arange(len(here)), np.maximum(here, 0))
        count[first : last + 1] += np.bincount(of * _N + _CLASS[flat[low:high]], minlength=len(here) * _N).reshape(-1, _N)
    return count


def _blocks(texts: Iterable[tuple[list[str], int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features by itself, length) of the lines of all texts, in blocks of bounded lines and characters.

    A text is given as its lines and the number of those before the first that is wanted.
    """
    lines: list[str] = []
    words: list[tuple] = []
    size = 0
    for own, skip in texts:
        seen: set[str] = set(own[:skip])
        for line in own[skip:] if skip else own:
            parts = line.split()
            n = len(parts)
            lines.append(line)
            words.append((n, len(set(parts)), sum(map(operator.eq, parts, parts[1:])) if n > 1 else 0, line in seen if n else False))
            seen.add(line)
            size += len(line)
            if len(lines) >= LINES or size >= CHARACTERS:
                yield _own(lines, words)
                lines, words, size = [], [], 0
    if lines:
        yield _own(lines, words)


def _own(lines: list[str], words: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [line.encode() for line in lines]
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
    flat = np.frombuffer(b"".join(encoded), np.uint8)
    count = _class_counts(flat, lengths)
    share = count / np.maximum(lengths, 1)[:, None]
    n, distinct, same, again = np.asarray(words, np.float64).reshape(-1, 4).T
    size = np.maximum(n, 1)
    letters = np.maximum(count[:, 0] + count[:, 1] + count[:, -1], 1)
    more = [np.ones(len(lines)), np.log1p(lengths) / 5, lengths / size / 10, distinct / size, same / size, again, count[:, 1] / letters]
    return np.column_stack([share, np.sqrt(share), *more]), lengths


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines, 3 * OWN + 2), line lengths, and the number of lines of each text: TRAIN_LINES of them at most.

    Of a longer text these are lines in a row from a place that a checksum of the text gives.
    """
    given, want, counts = [], [], []
    for text in texts:
        own = (text or "").split("\n")
        n = len(own)
        first = zlib.crc32((text or "").encode()) % (n - TRAIN_LINES + 1) if n > TRAIN_LINES else 0
        low, high = max(0, first - 1), min(n, first + TRAIN_LINES + 1)  # with the neighbours of the first and the last
        given.append((own[:high], low))
        want.append((low, high, first, min(n, first + TRAIN_LINES), n))
        counts.append(want[-1][3] - first)
    parts = list(_blocks(given))
    own, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    edge, chosen, at = np.zeros((len(own), 2)), np.zeros(len(own), bool), 0
    for low, high, first, upto, n in want:
        if first == 0:
            before[at], edge[at, 0] = 0, 1
        if upto == n:
            after[at + high - low - 1], edge[at + high - low - 1, 1] = 0, 1
        chosen[at + first - low : at + upto - low] = True
        at += high - low
    return np.concatenate([own, before, after, edge], axis=1)[chosen].astype(np.float32), lengths[chosen], np.asarray(counts)


@dataclass
class Model:
    weights: np.ndarray  # (features,): evidence that a line is good
    ties: np.ndarray  # (2, 2): from a line's label to the next one's
    slope: float
    shift: float


def marginals(evidence: np.ndarray, ties: np.ndarray, counts: np.ndarray):
    """P(good) of every line, the pair expectations summed over each text, and each text's log partition."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    live = np.searchsorted(-sizes, -np.arange(sizes.max(initial=0)), side="left")  # texts with more than t lines
    scores = np.column_stack([np.zeros(len(evidence)), evidence])
    ahead = np.empty_like(scores)
    for t, n in enumerate(live):
        at = starts[:n] + t
        if t:
            last = ahead[at - 1]
            ahead[at] = scores[at] + np.logaddexp(last[:, :1] + ties[0], last[:, 1:] + ties[1])
        else:
            ahead[at] = scores[at]
    ends = starts + sizes - 1
    total = np.empty(len(counts))
    total[order] = np.logaddexp(ahead[ends, 0], ahead[ends, 1])
    behind = np.zeros_like(scores)
    pairs = np.zeros((len(counts), 2, 2))
    for t in range(len(live) - 2, -1, -1):
        n = live[t + 1]
        at = starts[:n] + t
        later = scores[at + 1] + behind[at + 1]
        behind[at] = np.logaddexp(ties[:, 0] + later[:, :1], ties[:, 1] + later[:, 1:])
        pairs[order[:n]] += np.exp(ahead[at][:, :, None] + ties + later[:, None, :] - total[order[:n], None, None])
    of = np.repeat(np.arange(len(counts)), counts)
    return np.exp(ahead[:, 1] + behind[:, 1] - total[of]), pairs, total


def _step(x: float, ties: list[list[float]], way: int) -> float:
    """log((e^t[0][1] + e^(t[1][1] + x)) / (e^t[0][0] + e^(t[1][0] + x))) forward, with the ties turned round backward."""
    a, b, c, d = ties[0][0], ties[0][1], ties[1][0], ties[1][1]
    if way:
        b, c = c, b
    shift, other = (0.0, x) if x <= 0 else (-x, 0.0)
    return log(exp(b + shift) + exp(d + other)) - log(exp(a + shift) + exp(c + other))


def good_lines(evidence: np.ndarray, ties: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """P(good) of every line, as marginals gives it, by log odds: ahead, those of a line given the lines up to it, and behind.

    Lines at the same place of many texts go side by side; where fewer than FEW texts go on, each goes alone.
    """
    order = np.argsort(-counts, kind="stable")
    starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    live = np.searchsorted(-sizes, -np.arange(sizes.max(initial=0)), side="left")  # texts with more than t lines
    common = int((live >= FEW).sum())
    alone = [(int(s), int(s + n)) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n > common]
    ahead, behind, t = evidence.astype(np.float64), np.zeros(len(evidence)), ties.tolist()
    for k in range(1, common):
        at = starts[: live[k]] + k
        last = ahead[at - 1]
        ahead[at] += np.logaddexp(t[0][1], t[1][1] + last) - np.logaddexp(t[0][0], t[1][0] + last)
    for start, end in alone:
        own = evidence[start + common : end].tolist()
        x = float(ahead[start + common - 1]) if common else None
        for k, e in enumerate(own):
            x = own[k] = e if x is None else e + _step(x, t, 0)
        ahead[start + common : end] = own
        own = evidence[start + common : end].tolist()
        x = 0.0
        for k in range(len(own) - 1, -1, -1):
            e, own[k] = own[k], x
            x = _step(e + x, t, 1)
        behind[start + common : end] = own
    for k in range(common - 2, -1, -1):
        at = starts[: live[k + 1]] + k
        later = evidence[at + 1] + behind[at + 1]
        behind[at] = np.logaddexp(t[1][0], t[1][1] + later) - np.logaddexp(t[0][0], t[0][1] + later)
    for start, _ in alone if common else ():
        at = start + common - 1
        behind[at] = _step(float(evidence[at + 1] + behind[at + 1]), t, 1)
        for k in range(at - 1, start - 1, -1):
            behind[k] = _step(float(evidence[k + 1] + behind[k + 1]), t, 1)
    return 1 / (1 + np.exp(-np.clip(ahead + behind, -500, 500)))


def pooled(good: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of the marginals of each text weighted by line length; an empty line weighs as one byte."""
    of, weight = np.repeat(np.arange(len(counts)), counts), np.maximum(lengths, 1)
    return np.bincount(of, good * weight, len(counts)) / np.bincount(of, weight, len(counts))


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1))


def train(x: np.ndarray, lengths: np.ndarray, counts: np.ndarray, quality: np.ndarray, weight: np.ndarray) -> Model:
    """Maximum conditional likelihood by Adam, then a logistic calibration; weight: what a text stands for."""
    of = np.repeat(np.arange(len(counts)), counts)
    y = quality[of].astype(np.float64)
    even = np.where(quality == 1, 0.5 / max(1, (quality == 1).sum()), 0.5 / max(1, (quality == 0).sum()))
    per_text = even / np.sqrt(counts)  # long texts would otherwise outweigh all others
    per_text /= per_text.sum()
    scale = 1 / max(1e-9, float((per_text * counts).sum()))
    w, ties = np.zeros(x.shape[1]), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(ties), np.zeros_like(ties)]
    adjacent = np.zeros((len(counts), 2, 2))
    adjacent[np.arange(len(counts)), quality, quality] = counts - 1
    for step in range(1, STEPS + 1):
        good, pairs, _ = marginals(x @ w, ties, counts)
        g_w = x.T @ ((good - y) * per_text[of]) * scale + DECAY * w
        g_t = ((pairs - adjacent) * per_text[:, None, None]).sum(0) * scale + DECAY * ties
        for value, g, (m, s) in ((w, g_w, state[:2]), (ties, g_t, state[2:])):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    z = _logit(pooled(marginals(x @ w, ties, counts)[0], lengths, counts))
    slope, shift = 1.0, 0.0
    for _ in range(200):  # Newton steps on two numbers
        p = 1 / (1 + np.exp(-(slope * z + shift)))
        r, h = weight * (p - quality), weight * p * (1 - p) + 1e-9
        gradient = np.asarray([(r * z).sum() + 1e-3 * slope, r.sum()])
        curve = np.asarray([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum()]])
        move = np.linalg.solve(curve, gradient)
        slope, shift = slope - np.clip(move[0], -0.5, 0.5), shift - np.clip(move[1], -0.5, 0.5)
    return Model(w, ties, float(max(slope, 1e-3)), float(shift))


def score_texts(model: Model | None, texts: list[str | None]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    # a line's evidence is a sum over its own features and its neighbours', so three numbers a line are kept
    own_w, before_w, after_w, first_w, last_w = np.split(model.weights, [OWN, 2 * OWN, 3 * OWN, 3 * OWN + 1])
    parts = [(own @ np.column_stack([own_w, before_w, after_w]), lengths) for own, lengths in _blocks(((t or "").split("\n"), 0) for t in texts)]
    x, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    counts = np.asarray([(t or "").count("\n") + 1 for t in texts])
    ends = np.cumsum(counts)
    before, after = np.roll(x[:, 1], 1), np.roll(x[:, 2], -1)
    before[ends - counts], after[ends - 1] = first_w[0], last_w[0]
    z = _logit(pooled(good_lines(x[:, 0] + before + after, model.ties, counts), lengths, counts))
    return 1 / (1 + np.exp(-(model.slope * z + model.shift)))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on SAMPLE labelled documents a class outside the held-out fold, drawn by a hash of the id."""
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)").where(fold("doc_id", 3) != 1)
    known = known.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("times"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    drawn = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for q in (0, 1)]
    drawn = drawn[0].unionByName(drawn[1]).select(F.col("doc_id").alias("of_doc"), "quality")

    def make():
        def work(texts: list[str | None]) -> list[list]:
            out: list[list] = [[], []]
            for at in range(0, len(texts), GROUP):
                x, lengths, counts = line_features(texts[at : at + GROUP])
                for column, values in zip(out, (x, lengths), strict=True):
                    column += [v.tobytes() for v in np.split(values, np.cumsum(counts)[:-1])]
            return out

        return work

    # at most 2 * SAMPLE ids are broadcast; as many rows return, of TRAIN_LINES lines each at most
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).join(F.broadcast(drawn), F.col("doc_id") == F.col("of_doc"))
    found = map_column(texts, ["quality", "doc_id", "key"], "text", make, "x binary, lengths binary")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", "key", "quality").limit(2 * SAMPLE).collect()
    if len({r["quality"] for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], bytes(r["x"])))
    width = 3 * OWN + 2
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, width) for r in rows])
    lengths = [np.frombuffer(r["lengths"], np.int64) for r in rows]
    quality = np.asarray([r["quality"] for r in rows])
    stands = np.where(quality == 1, sizes[1] / max(1, (quality == 1).sum()), sizes[0] / max(1, (quality == 0).sum()))
    return train(x, np.concatenate(lengths), np.asarray(list(map(len, lengths))), quality, stands / stands.mean())


def score(docs: DataFrame, keep: list[str], model: Model | None) -> DataFrame:
    """The kept columns with score and predicted for every whole text."""

    def make():
        def work(texts: list[str | None]) -> list[list]:
            found = score_texts(model, texts)
            return [found, (found >= 0.5).astype(np.int32)]

        return work

    return map_column(docs, keep, "text", make, "score double, predicted int")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    found = score(docs.withColumn("held_out", fold("doc_id", 3) == 1), ["doc_id", "held_out"], model)
    return found.select("doc_id", "held_out", "score", "predicted")
