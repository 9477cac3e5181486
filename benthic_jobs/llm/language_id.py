"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Two recurrent layers read the UTF-8 bytes of a text, one from each side; their states at a byte give the
probabilities of the languages there, so that every position is labelled. A document's probabilities are the mean
over its positions. Texts are read in cores of ``CORE`` bytes with ``CONTEXT`` more on both sides to settle the
states; every byte of the whole text lies in one core.

The weights are learned by backpropagation through time and Adam from windows of about ``quota`` documents of each
language (a documented bound; the choice goes by a hash of the id). Only text and language are read, of rows that
may be learned from and have a language. A null text, or one without letters, is ``und`` with a score of 0; so is
everything if there is nothing to learn from. Equal texts get equal labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, slices

CORE, CONTEXT, LANES, HIDDEN = 128, 16, 4096, 8
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether there is a character of the Unicode category L; numerals such as one half are none."""
    return bool(text) and any(m[0].isalpha() for m in _WORD.finditer(text))


class Gru:
    """One direction: gates from a table by byte and from the state. Sigmoids are shifted hyperbolic tangents."""

    def __init__(self, rng: np.random.Generator, hidden: int) -> None:
        self.byte = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.byte[:, 0] = 0
        self.state = rng.normal(0, 0.6 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)

    def run(self, steps: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each step (time, hidden, lanes) for bytes (time, lanes)."""
        n = self.state.shape[1]
        h = np.zeros((n, steps.shape[1]), np.float32)
        out, kept = np.empty((len(steps), *h.shape), np.float32), []
        for t, x in enumerate(steps):
            g, a = self.byte.take(x, axis=1), self.state @ h
            gates = np.tanh((g[: 2 * n] + a[: 2 * n]) * np.float32(0.5))
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            z, r = gates[:n], gates[n:]
            new = np.tanh(g[2 * n :] + r * a[2 * n :])
            if keep:
                kept.append((h, z, r, new, a[2 * n :]))
            h = new + z * (h - new)
            out[t] = h
        return out, kept

    def back(self, steps: np.ndarray, kept: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``byte`` and ``state``, backwards through time."""
        n = self.state.shape[1]
        d_byte, d_state = np.zeros_like(self.byte), np.zeros_like(self.state)
        after = np.zeros_like(grad[0])
        into = np.empty((len(steps), 3 * n, steps.shape[1]), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            h, z, r, new, part = kept[t]
            d = grad[t] + after
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (h - new) * z * (1 - z)
            d_r = d_new * part * r * (1 - r)
            into[t, :n], into[t, n : 2 * n], into[t, 2 * n :] = d_z, d_r, d_new
            d_a = np.concatenate([d_z, d_r, d_new * r])
            d_state += d_a @ h.T
            after = d * z + self.state.T @ d_a
        flat, rows = steps.ravel(), into.transpose(1, 0, 2).reshape(3 * n, -1)
        for i in range(3 * n):
            d_byte[i] = np.bincount(flat, rows[i], 256)
        return d_byte, d_state


class ByteTagger:
    def __init__(self, languages: list[str], *, hidden: int = HIDDEN, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Gru(rng, hidden), Gru(rng, hidden)
        self.top = rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def _weights(self) -> list[np.ndarray]:
        return [self.ahead.byte, self.ahead.state, self.behind.byte, self.behind.state, self.top, self.bias]

    def _states(self, steps: np.ndarray, keep: bool = False):
        a, kept_a = self.ahead.run(steps, keep)
        b, kept_b = self.behind.run(steps[::-1], keep)
        return np.concatenate([a, b[::-1]], axis=1), kept_a, kept_b

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(time, languages, lanes)"""
        logits = self.top @ states + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def fit(self, texts: list[bytes], labels: np.ndarray, *, rounds: int = 260, lanes: int = 128, length: int = 80, rate: float = 0.02) -> ByteTagger:
        """Adam on the mean cross entropy of all positions of random windows, the languages in equal shares."""
        rng = np.random.default_rng(5)
        by_language = [np.flatnonzero(labels == i) for i in range(len(self.languages))]
        mean, square = [np.zeros_like(w) for w in self._weights()], [np.zeros_like(w) for w in self._weights()]
        for step in range(1, rounds + 1):
            chosen = np.array([rng.choice(by_language[i % len(by_language)]) for i in range(lanes)])
            x, real = np.zeros((length, lanes), np.uint8), np.zeros((length, lanes), bool)
            for lane, i in enumerate(chosen):
                begin = rng.integers(0, max(1, len(texts[i]) - length + 1))
                piece = np.frombuffer(texts[i][begin : begin + length], np.uint8)
                x[: len(piece), lane], real[: len(piece), lane] = piece, True
            states, kept_a, kept_b = self._states(x, keep=True)
            error = self.probabilities(states)
            error[:, labels[chosen], np.arange(lanes)] -= 1
            error *= real[:, None, :] / np.float32(real.sum())
            d_states = self.top.T @ error
            n = self.ahead.state.shape[1]
            grads = [
                *self.ahead.back(x, kept_a, d_states[:, :n]), *self.behind.back(x[::-1], kept_b, d_states[::-1, n:]),
                np.einsum("tlb,thb->lh", error, states, optimize=True), error.sum(axis=(0, 2))[:, None],
            ]
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            pace = rate * min(1.0, 3 * (1 - step / (rounds + 1)))
            for w, g, m, v in zip(self._weights(), grads, mean, square):
                g = g * np.float32(min(1.0, 1.0 / (norm + 1e-12)))
                m += (g - m) * np.float32(0.1)
                v += (g * g - v) * np.float32(0.005)
                w -= np.float32(pace) * (m / np.float32(1 - 0.9**step)) / (np.sqrt(v / np.float32(1 - 0.995**step)) + np.float32(1e-7))
        return self

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """The mean probabilities (text, language) over all positions; zeros for empty texts."""
        total = np.zeros((len(texts), len(self.languages)))
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(lens + CONTEXT) - lens
        raw = np.frombuffer(b"".join(x for t in texts for x in (bytes(CONTEXT), t)) + bytes(CORE + 2 * CONTEXT), np.uint8)
        cores = -(-lens // CORE)
        text = np.repeat(np.arange(len(texts)), cores)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(cores) - cores, cores)) * CORE + begin[text]
        span = np.arange(-CONTEXT, CORE + CONTEXT)[:, None]
        for i in range(0, len(text), LANES):
            own, start = text[i : i + LANES], at[i : i + LANES]
            place = start + span
            steps = np.where(place < begin[own] + lens[own], raw[np.minimum(place, len(raw) - 1)], 0).astype(np.uint8)
            states, _, _ = self._states(steps)
            real = place[CONTEXT:-CONTEXT] < begin[own] + lens[own]
            inner = self.probabilities(states[CONTEXT:-CONTEXT])
            sums = np.einsum("tlb,tb->lb", inner, real.astype(np.float32), optimize=True)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(own, sums[k], len(texts))
        return total / np.maximum(lens, 1)[:, None]


def training_windows(docs: DataFrame, train: Column, *, quota: int, chars: int = 400) -> DataFrame:
    """About ``quota`` rows (text, lang) of each language: windows of ``chars`` characters at hashed places."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")).where(train)
    known = known.select("text", "lang", F.xxhash64(F.lit("sample"), "doc_id", "text").alias("h"))
    share = known.groupBy("lang").agg((F.lit(float(quota)) / F.count("*")).alias("share"))  # a row for each language
    some = known.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    start = F.floor(F.pmod(F.shiftright("h", 20), F.lit(1000)) / 1000 * F.greatest(F.char_length("text") - chars, F.lit(0))) + 1
    return some.select("lang", "h", F.substring("text", start.cast("int"), F.lit(chars)).alias("text"))


def fit(docs: DataFrame, *, train: Column, quota: int = 500, **options) -> ByteTagger | None:
    rows = training_windows(docs, train, quota=quota).orderBy("lang", "h").collect()  # about quota rows a language
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return None
    labels = np.array([languages.index(r["lang"]) for r in rows])
    return ByteTagger(languages).fit([r["text"].encode() for r in rows], labels, **options)


def tagged(docs: DataFrame, model: ByteTagger | None, *, text_col: str = "text", step_bytes: int = 8_000_000) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    Columns of these two names are replaced, all others stay. Of languages with equal probabilities the first by name is taken.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lettered = [has_letter(t) for t in batch]
            texts = [t.encode("utf-8", "replace") if ok else b"" for t, ok in zip(batch, lettered)]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for part in slices([len(t) for t in texts], step_bytes) if shared.value else ():
                pooled = shared.value.pooled(texts[part])
                for i, best in enumerate(pooled.argmax(axis=1), part.start):
                    if lettered[i]:
                        names[i], scores[i] = shared.value.languages[best], pooled[i - part.start, best]
            yield pd.DataFrame({"lang_pred": names, "score": np.clip(scores, 0, 1)})

    found = free_name(docs, "__found")
    out = docs.withColumn(found, predict(F.col(text_col)))
    return out.withColumns({c: F.col(f"{found}.{c}") for c in ("lang_pred", "score")}).drop(found)
