"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Index of the symbol that fills up a text's last window.
PAD = 256
#: Windows that go through the network together.
_WINDOWS = 2048


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: the network's squashing function, a few cheap steps a number."""
    scale = np.abs(x)
    scale += 1
    x /= scale
    return x


@dataclass
class Network:
    """One gated layer per direction; at every byte a softmax over the languages.

    Input weights are one row a byte (update gate, reset gate and candidate side by side).
    """

    languages: list[str]
    window: int
    hidden: int
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, languages: Sequence[str], window: int, hidden: int, rng: np.random.Generator) -> Network:
        made = {"b": np.zeros(len(languages))}
        for way in "fb":
            made |= {
                f"x{way}": rng.normal(0, 0.3, (PAD + 1, 3 * hidden)),
                f"u{way}": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)),
                f"w{way}": rng.normal(0, hidden**-0.5, (hidden, len(languages))),
            }
        return cls(list(languages), window, hidden, {k: v.astype(np.float32) for k, v in made.items()})

    def states(self, way: str, symbols: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, window, unit) after each symbol of (time, window), in reading order."""
        x, u, n = self.weights[f"x{way}"], self.weights[f"u{way}"], self.hidden
        out = np.empty((*symbols.shape, n), x.dtype)
        h = np.zeros((symbols.shape[1], n), x.dtype)
        for t in range(len(symbols)):
            a, s = np.take(x, symbols[t], axis=0), h @ u
            gates = _soft(a[:, : 2 * n] + s[:, : 2 * n])  # in -1 to 1; a gate is (1 + this) / 2
            gates += 1
            gates *= 0.5
            z, r = gates[:, :n], gates[:, n:]
            c = r * s[:, 2 * n :]
            c += a[:, 2 * n :]
            c = _soft(c)
            if keep is not None:
                keep.append((h, z, r, c, s[:, 2 * n :]))
            mixed = h - c
            mixed *= z
            mixed += c
            h = out[t] = mixed
        return out

    def probabilities(self, symbols: np.ndarray) -> np.ndarray:
        """Language probabilities of every position of (time, window)."""
        w = self.weights
        logits = self.states("f", symbols) @ w["wf"]
        logits += self.states("b", symbols[::-1])[::-1] @ w["wb"] + w["b"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True)

    def gradients(self, symbols: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the real positions, and its gradient through time."""
        w, grads = self.weights, {}
        kept: dict[str, list] = {"f": [], "b": []}
        order = {"f": symbols, "b": symbols[::-1]}
        states = {way: self.states(way, order[way], kept[way]) for way in "fb"}
        seen = {"f": states["f"], "b": states["b"][::-1]}
        logits = seen["f"] @ w["wf"] + seen["b"] @ w["wb"] + w["b"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        p = e / e.sum(axis=2, keepdims=True)
        real = symbols != PAD
        right = np.broadcast_to(label, symbols.shape)[..., None] == np.arange(len(self.languages))
        count = max(1, int(real.sum()))
        loss = -float(np.log(np.maximum((p * right).sum(axis=2), 1e-9))[real].sum()) / count
        d = ((p - right) * real[..., None] / count).astype(np.float32)
        grads["b"] = d.sum(axis=(0, 1))
        for way in "fb":
            grads[f"w{way}"] = np.tensordot(seen[way], d, axes=([0, 1], [0, 1]))
            back = d @ w[f"w{way}"].T
            grads |= self._through_time(way, order[way], kept[way], back if way == "f" else back[::-1])
        return loss, grads

    def _through_time(self, way: str, symbols: np.ndarray, kept: list, back: np.ndarray) -> dict[str, np.ndarray]:
        n, u = self.hidden, self.weights[f"u{way}"]
        du, inputs = np.zeros_like(u), np.empty((*symbols.shape, 3 * n), np.float32)
        carry = np.zeros_like(back[0])
        for t in range(len(symbols) - 1, -1, -1):
            h, z, r, c, s = kept[t]
            dh = back[t] + carry
            dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
            dz = dh * (h - c) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = dc * s * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            inputs[t] = np.concatenate([dz, dr, dc], axis=1)
            ds = np.concatenate([dz, dr, dc * r], axis=1)
            du += h.T @ ds
            carry = dh * z + ds @ u.T
        flat, rows = symbols.ravel(), inputs.reshape(-1, 3 * n)
        by = np.argsort(flat, kind="stable")
        found, at = np.unique(flat[by], return_index=True)
        dx = np.zeros_like(self.weights[f"x{way}"])
        dx[found] = np.add.reduceat(rows[by], at, axis=0)
        return {f"u{way}": du, f"x{way}": dx}


def windows_of(data: bytes, window: int) -> np.ndarray:
    """(window, time) symbols of all bytes, the last window padded."""
    count = max(1, -(-len(data) // window))
    out = np.full(count * window, PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(count, window)


def train(
    samples: Sequence[tuple[str, str]],
    window: int = 64,
    hidden: int = 12,
    steps: int = 300,
    batch: int = 192,
    rate: float = 0.02,
    seed: int = 7,
) -> Network:
    """A network learned by Adam from (language, text) samples; languages count alike."""
    languages = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    net = Network.new(languages, window, hidden, rng)
    if len(languages) < 2:
        return net
    of = {lang: [windows_of(t.encode("utf-8", "surrogatepass"), window) for k, t in samples if k == lang] for lang in languages}
    pools = [np.concatenate(of[lang]) for lang in languages]
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, steps + 1):
        label = rng.integers(len(languages), size=batch)
        rows = np.stack([pools[k][rng.integers(len(pools[k]))] for k in label])
        _, grads = net.gradients(rows.T.astype(np.int64), label)
        size = rate * (1 - step / (steps + 1)) ** 0.5
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            change = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
            net.weights[k] = (net.weights[k] - size * change).astype(np.float32)
    return net


def pooled(net: Network, texts: Sequence[bytes]) -> np.ndarray:
    """(text, language): mean over all bytes of a text of their language probabilities.

    Windows of many texts share a pass, and a long text takes several: memory is that of
    `_WINDOWS` windows, not of the text.
    """
    sums = np.zeros((len(texts), len(net.languages)))

    def run(rows: list[np.ndarray], owners: list[np.ndarray]) -> None:
        symbols = np.ascontiguousarray(np.concatenate(rows).T)
        p = net.probabilities(symbols) * (symbols != PAD)[..., None]
        np.add.at(sums, np.concatenate(owners), p.sum(axis=0, dtype=np.float64))

    rows, owners, waiting = [], [], 0
    for i, data in enumerate(texts):
        for at in range(0, len(data), _WINDOWS * net.window):
            part = windows_of(data[at : at + _WINDOWS * net.window], net.window)
            if waiting + len(part) > _WINDOWS and rows:
                run(rows, owners)
                rows, owners, waiting = [], [], 0
            rows.append(part)
            owners.append(np.full(len(part), i))
            waiting += len(part)
    if rows:
        run(rows, owners)
    return sums / np.maximum([[len(t)] for t in texts], 1) if len(texts) else sums


def sample(
    documents: DataFrame, lang: str = "lang", text: str = "text", row_id: str = "doc_id",
    per_language: int = 256, characters: int = 256,
) -> list[tuple[str, str]]:
    """At most `per_language` labelled excerpts of each language, drawn by hash from all rows.

    Rows of a language fall into `per_language` cells by the hash of their id; a cell gives the
    excerpt with the smallest second hash, so a task sends at most that many rows a language and
    no language, however frequent, is gathered anywhere. The excerpt starts at a hashed place.
    """
    h = F.xxhash64(F.col(row_id), F.col(text))
    spare = F.greatest(F.length(text) - characters, F.lit(0)) + 1
    excerpt = F.substring(F.col(text), (F.pmod(h, spare) + 1).cast("int"), F.lit(characters))
    labelled = documents.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    drawn = labelled.groupBy(F.col(lang).cast("string").alias("lang"), F.pmod(F.hash(row_id), F.lit(per_language)).alias("cell")).agg(
        F.min_by(F.struct(excerpt.alias("text")), F.struct(F.xxhash64(h).alias("h"), F.col(row_id))).alias("best")
    )
    return sorted((r["lang"], r["best"]["text"]) for r in drawn.collect() if r["best"]["text"])


def held_out(row_id: Column) -> Column:
    """Documents that are never learned from: CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(row_id.cast("string")) % 3 == 1, F.lit(False))


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode's category L; numerals such as ½ or Ⅷ are not."""
    return any(map(str.isalpha, text))


def predict(documents: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """Adds lang_pred and lang_score (mean probability of that language) to every row.

    Every byte of the whole text is labelled, in windows of `net.window` bytes; their
    probabilities are averaged. Null texts, texts without a letter, and all texts if nothing was
    learned: `und` and 0. Ties go to the first language in order. Only the text goes to Python;
    rows are independent, so repeated rows repeat their result and an empty table gives an empty
    one. Input columns of the new names are replaced.
    """

    @F.pandas_udf("struct<lang:string,score:double>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [bool(net.languages) and t is not None and has_letter(t) for t in batch]
            data = [t.encode("utf-8", "surrogatepass") if k else b"" for t, k in zip(batch, known, strict=True)]
            p = pooled(net, data)
            best = p.argmax(axis=1) if net.languages else np.zeros(len(batch), int)
            yield pd.DataFrame(
                {
                    "lang": [net.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)],
                    "score": [min(1.0, float(p[j, i])) if k else 0.0 for j, (i, k) in enumerate(zip(best, known, strict=True))],
                }
            )

    kept = [c for c in documents.columns if c.lower() not in {"lang_pred", "lang_score", "_found"}]
    found = F.col("_found")
    return documents.select(*kept, label(F.col(text).cast("string")).alias("_found")).select(
        *kept, found["lang"].alias("lang_pred"), found["score"].alias("lang_score")
    )


def identify(documents: DataFrame, lang: str = "lang", text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """`predict` with a network learned from those labelled rows of `documents` that are not held out."""
    labelled = documents.where(~held_out(F.col(row_id)))
    return predict(documents, train(sample(labelled, lang, text, row_id)), text)
