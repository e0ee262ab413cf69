"""Language identification by a bidirectional gated recurrent network over bytes, trained here in numpy.

Whole texts are cut into windows of WINDOW bytes; in each, one recurrence runs forward and one backward, every byte gets
a distribution over languages from both states, and a document's distribution is the mean over all its bytes of letters:
digits, signs and blanks have labels too but tell no language. Training
is backpropagation through time over a bounded sample of labelled windows (parameters below); prediction reads every
byte of every text and nothing else. Beside the languages there is a label for none of them, learned from the same windows
with their letters in disguise; it is never predicted, but its share keeps the score of texts in other languages low.

Defined cases: a text that is null or has no letter is `und` with score 0; repeated rows give equal rows; where no
labelled row exists every text is `und`; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fold, map_column, table

#: Units of each direction, and bytes over which a recurrence runs.
UNITS, WINDOW = 8, 128
#: The training sample: documents a language, windows a document, characters a window before encoding.
SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_CHARS = 400, 3, 96
#: Languages with a full sample and full batches; beyond, samples a language and rows a batch shrink, so that neither grows.
FULL_LANGUAGES = 400
STEPS, BATCH, SPAN, RATE = 500, 192, 64, 0.02
#: Tables that turn known languages into none.
DISGUISES = 256
#: Windows that run through the network at a time.
ROWS = 2048

_LETTER = regex.compile(r"\p{L}")
#: Bytes whose labels count for the document: ASCII letters and all parts of longer characters.
_COUNTS = np.zeros(256, np.float32)
_COUNTS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = 1


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (2, 256, 3 units): what a byte adds to the gates of each direction, biases included
    recur: np.ndarray  # (2, units, 3 units)
    inner: np.ndarray  # (2, units): bias of the candidate's recurrent part
    out: np.ndarray  # (2 units, languages and none of them)
    bias: np.ndarray  # (languages and none of them,)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _start(languages: list[str], seed: int) -> Model:
    rng, n = np.random.default_rng(seed), len(languages) + 1
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    model = Model(
        languages, normal(2, 256, 3 * UNITS, scale=0.3), normal(2, UNITS, 3 * UNITS, scale=UNITS**-0.5),
        np.zeros((2, UNITS), np.float32), normal(2 * UNITS, n, scale=0.3), np.zeros(n, np.float32),
    )
    model.table[:, :, UNITS : 2 * UNITS] -= 1  # start with states that remember
    return model


def _forward(model: Model, way: int, text: np.ndarray):
    """One direction over text (time, rows): states before each step and what backpropagation needs."""
    u, steps = UNITS, []
    h = np.zeros((text.shape[1], u), np.float32)
    for at in range(len(text)):
        given, own = model.table[way][text[at]], h @ model.recur[way]
        gates = _sigmoid(given[:, : 2 * u] + own[:, : 2 * u])
        reset, update = gates[:, :u], gates[:, u:]
        inner = own[:, 2 * u :] + model.inner[way]
        candidate = np.tanh(given[:, 2 * u :] + reset * inner)
        steps.append((h, reset, update, inner, candidate))
        h = candidate + update * (h - candidate)
    return steps, np.stack([s[0] for s in steps[1:]] + [h])


def _backward(model: Model, way: int, text: np.ndarray, steps: list, upper: np.ndarray, grads: Model) -> None:
    """Backpropagation through time: adds the gradients of one direction, given those of its states."""
    u = UNITS
    later = np.zeros_like(steps[0][0])
    into_tables = np.empty((*text.shape, 3 * u), later.dtype)
    for at in reversed(range(len(text))):
        h, reset, update, inner, candidate = steps[at]
        d = later + upper[at]
        d_candidate = d * (1 - update) * (1 - candidate**2)
        d_update = d * (h - candidate) * update * (1 - update)
        d_inner = d_candidate * reset
        d_reset = d_candidate * inner * reset * (1 - reset)
        into_tables[at] = np.concatenate([d_reset, d_update, d_candidate], axis=1)
        into_own = np.concatenate([d_reset, d_update, d_inner], axis=1)
        grads.recur[way] += h.T @ into_own
        grads.inner[way] += d_inner.sum(0)
        later = d * update + into_own @ model.recur[way].T
    flat, columns = text.reshape(-1), into_tables.reshape(-1, 3 * u).T
    grads.table[way] += np.stack([np.bincount(flat, column, 256) for column in columns], axis=1)


def _gradients(model: Model, text: np.ndarray, label: np.ndarray) -> tuple[Model, float]:
    grads = Model(model.languages, *(np.zeros_like(x) for x in (model.table, model.recur, model.inner, model.out, model.bias)))
    ahead, states = _forward(model, 0, text)
    back, behind = _forward(model, 1, text[::-1])
    both = np.concatenate([states, behind[::-1]], axis=2)
    logits = both @ model.out + model.bias
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    loss = -np.log(p[:, np.arange(len(label)), label] + 1e-9).mean()
    d = p
    d[:, np.arange(len(label)), label] -= 1
    d /= text.size
    grads.out += np.einsum("tbh,tbl->hl", both, d)
    grads.bias += d.sum((0, 1))
    upper = d @ model.out.T
    _backward(model, 0, text, ahead, upper[:, :, :UNITS], grads)
    _backward(model, 1, text[::-1], back, upper[::-1, :, UNITS:], grads)
    return grads, float(loss)


def disguise(rng: np.random.Generator) -> list[bytes]:
    """A table of bytes that turns a text of a known language into one of none.

    Vowels trade places and consonants do, or all letters do, or letters move to another script; blanks, digits and
    signs stay. Bytes within longer characters trade places too.
    """
    vowels, table = b"aeiouy", [bytes([b]) for b in range(256)]
    letters = bytes(range(ord("a"), ord("z") + 1))
    way = rng.integers(3)
    groups = [letters] if way else [vowels, bytes(set(letters) - set(vowels))]
    script = int(rng.integers(0xC4, 0xE0))
    for group in groups:
        for old, new in zip(group, rng.permutation(list(group)).tolist(), strict=True):
            for shift in (0, 32):
                table[old - shift] = bytes([new - shift]) if way < 2 else bytes([script, 0x80 + (new - ord("a")) + shift])
    for old, new in zip(range(0x80, 0xC0), rng.permutation(0x40).tolist(), strict=True):
        table[old] = bytes([0x80 + new])
    return table


def train(samples: list[tuple[bytes, str]], seed: int = 0, steps: int = STEPS) -> Model | None:
    """Adam over random spans of the samples, languages drawn evenly, and as often spans in none of them (disguise)."""
    languages = sorted({language for _, language in samples})
    if not languages:
        return None
    samples = sorted(samples)
    rng = np.random.default_rng(seed)
    of = [[text for text, language in samples if language == x] for x in languages]
    model = _start(languages, seed)
    weights = [model.table, model.recur, model.inner, model.out, model.bias]
    none = len(languages)
    batch = max(1, BATCH * FULL_LANGUAGES // max(FULL_LANGUAGES, len(languages)))
    steps = steps * BATCH // batch
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    tables = [disguise(rng) for _ in range(DISGUISES)]
    for step in range(1, steps + 1):
        label = rng.integers(none + 1, size=batch)
        text = np.zeros((SPAN, batch), np.uint8)
        for i, x in enumerate(label):
            own = of[x if x < none else rng.integers(none)]
            chosen = own[rng.integers(len(own))]
            if x == none:
                chosen = b"".join(map(tables[rng.integers(DISGUISES)].__getitem__, chosen))
            at = rng.integers(max(1, len(chosen) - SPAN + 1))
            piece = np.frombuffer(chosen[at : at + SPAN], np.uint8)
            text[: len(piece), i] = piece
        grads, _ = _gradients(model, text, label)
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for w, g, m, s in zip(weights, [grads.table, grads.recur, grads.inner, grads.out, grads.bias], mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return model


class Predictor:
    """Runs the network over many windows at a time, both directions in one state."""

    def __init__(self, model: Model):
        u, self.model = UNITS, model
        # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2: the halves go into the weights, so that one tanh serves both gates
        scale = np.repeat(np.asarray([0.5, 0.5, 1], np.float32), u)
        ahead, back = model.table * scale
        zero = np.zeros((u, u), np.float32)
        recur = model.recur * scale
        pick = lambda way, gate: recur[way][:, gate * u : gate * u + u]
        self.recur = np.concatenate([np.block([[pick(0, g), zero], [zero, pick(1, g)]]) for g in range(3)], axis=1)
        self.ahead = [np.ascontiguousarray(ahead[:, g * u : g * u + u]) for g in range(3)]
        self.back = [np.ascontiguousarray(back[:, g * u : g * u + u]) for g in range(3)]
        wide = np.zeros((2, 256, 3, 2, u), np.float32)
        for g in range(3):
            wide[0, :, g, 0], wide[1, :, g, 1] = self.ahead[g], self.back[g]
        wide = wide.reshape(2, 256, 6 * u)
        self.wide = wide
        self.inner = model.inner.reshape(-1)

    def positions(self, text: np.ndarray) -> np.ndarray:
        """(rows, time) bytes to (time, rows, languages and none of them) probabilities."""
        u, (rows, time) = UNITS, text.shape
        columns = np.ascontiguousarray(text.T)
        states = np.empty((2, time, rows, u), np.float32)
        h = np.zeros((rows, 2 * u), np.float32)
        given, other, own = (np.empty((rows, 6 * u), np.float32) for _ in range(3))
        gates, fresh = np.empty((rows, 4 * u), np.float32), np.empty((rows, 2 * u), np.float32)
        for at in range(time):
            np.take(self.wide[0], columns[at], axis=0, out=given, mode="clip")
            np.take(self.wide[1], columns[time - 1 - at], axis=0, out=other, mode="clip")
            given += other
            np.matmul(h, self.recur, out=own)
            np.add(given[:, : 4 * u], own[:, : 4 * u], out=gates)
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            np.add(own[:, 4 * u :], self.inner, out=fresh)
            fresh *= gates[:, : 2 * u]
            fresh += given[:, 4 * u :]
            np.tanh(fresh, out=fresh)
            h -= fresh
            h *= gates[:, 2 * u :]
            h += fresh
            states[0, at], states[1, time - 1 - at] = h[:, :u], h[:, u:]
        logits = states[0].reshape(-1, u) @ self.model.out[:u]
        logits += states[1].reshape(-1, u) @ self.model.out[u:]
        logits += self.model.bias
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits.reshape(time, rows, -1)

    def windows(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded windows of all texts, their lengths, and the text each belongs to."""
        counts = [-(-len(t) // WINDOW) for t in texts]
        flat = np.frombuffer(b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True)), np.uint8)
        of = np.repeat(np.arange(len(texts)), counts)
        lengths = np.full(len(of), WINDOW)
        if len(of):
            lengths[np.cumsum(counts) - 1] = [len(t) - (n - 1) * WINDOW for t, n in zip(texts, counts, strict=True)]
        return flat.reshape(-1, WINDOW), lengths, of

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over the bytes of letters of each text; every text has one."""
        text, lengths, of = self.windows(texts)
        total = np.zeros((len(texts), len(self.model.bias)))
        order = np.argsort(lengths, kind="stable")
        most = max(1, ROWS * 8 // max(8, len(self.model.languages)))
        for at in range(0, len(order), most):
            own = order[at : at + most]
            time = lengths[own].max()
            here = text[own, :time]
            # padding is no letter, so it counts for nothing
            np.add.at(total, of[own], np.einsum("trl,tr->rl", self.positions(here), _COUNTS[here.T]))
        return total / total.sum(1, keepdims=True)


def sample(docs: DataFrame) -> list[tuple[bytes, str]]:
    """A bounded sample of labelled windows: about SAMPLE_DOCS documents of every language (fewer if there are very many), drawn by a hash of id and text."""
    known = docs.where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    most = max(1, SAMPLE_DOCS * FULL_LANGUAGES // max(FULL_LANGUAGES, len(counts)))
    share = F.from_json(F.lit(json.dumps({lang: min(1.0, most / n) for lang, n in counts.items()})), "map<string,double>")
    draw = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    at = lambda k: F.substring("text", (draw(k + 1) * F.length("text")).cast("int") + 1, F.lit(SAMPLE_CHARS))
    drawn = known.where(draw(0) < share[F.col("lang")])
    names = [f"w{k}" for k in range(SAMPLE_WINDOWS)]
    drawn = drawn.select("lang", draw(0).alias("drawn"), *(at(k).alias(name) for k, name in enumerate(names)))
    rows = drawn.orderBy("drawn", "lang", *names).limit(4 * most * len(counts)).collect()  # many equal rows may be drawn at once
    return [(r[f"w{k}"].encode(), r["lang"]) for r in rows for k in range(SAMPLE_WINDOWS) if _LETTER.search(r[f"w{k}"])]


def predict(docs: DataFrame, keep: list[str], model: Model | None) -> DataFrame:
    """The kept columns with lang_pred and score for every whole text."""

    def make():
        predictor = Predictor(model) if model else None

        def work(texts: list[str | None]) -> list[list]:
            label, score = ["und"] * len(texts), [0.0] * len(texts)
            known = [i for i, text in enumerate(texts) if predictor and text and _LETTER.search(text)]
            if known:
                p = predictor.documents([texts[i].encode() for i in known])[:, : len(model.languages)]
                for i, best, value in zip(known, p.argmax(1), p.max(1), strict=True):
                    label[i], score[i] = model.languages[best], min(1.0, float(value))
            return [label, score]

        return work

    return map_column(docs, keep, "text", make, "lang_pred string, score double")


def learn(docs: DataFrame) -> Model | None:
    """A model from the documents outside the held-out fold."""
    return train(sample(docs.where(fold("doc_id", 5) != 0)))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.withColumn("held_out", fold("doc_id", 5) == 0), ["doc_id", "held_out"], learn(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")
