"""Personal data: fixed patterns and a character-level BiLSTM-CRF.

Base kinds (email, ip, card, phone) are patterns with checks. The model is
trained in numpy on labelled spans (by default the base spans of a bounded
sample of documents) and adds spans that the patterns miss.

A text is read in windows of ``WINDOW`` characters, half overlapping. Each
kind holds a digit or an at sign, so windows that hold neither cannot contain
a span and are not run; a chain of neighbouring windows is a stretch. The
emissions of overlapping windows are averaged, nearer to a window's middle
counting more, and each stretch is decoded once, as a whole, by the CRF: the
windows are reconciled before tags are chosen, so no span breaks at a seam.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the base kinds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

WINDOW, STRIDE = 64, 32
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
#: The fit reads at most so many documents that hold a digit or an at sign, and so many of their windows.
TRAIN_DOCS, TRAIN_WINDOWS = 800, 2400
HIDDEN, EMBED, EPOCHS, SEED = 12, 6, 5, 7

_CLASSES = 16


def _class_table() -> np.ndarray:
    """Character classes of code points below 128; others are letters or not."""
    t = np.full(128, 14, np.uint8)
    for i, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "@", ".", "-", "+",
                               "(", ")", " ", "_%", "\n\r\t\v\f", ":=/", ",;!?"), 1):
        t[[ord(c) for c in chars]] = i
    t[14] = 14
    return t


_TABLE = _class_table()
_DIGIT, _AT = 3, 4


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(codes < 128, _TABLE[np.minimum(codes, 127)], 15).astype(np.uint8)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start. Each search is linear in the text."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        low = at
        while low > last and text[low - 1] in LOCAL:
            low -= 1
        domain = DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            out.append((0, low, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    if not DIGIT.search(text):
        return out
    for m in NUMBERS.finditer(text):
        parts, start = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i:i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts[i:i + 4]):
                out.append((1, start, start + size))
            start += size + 1
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def starts_of(cls: np.ndarray) -> np.ndarray:
    """Starts of the windows (multiples of ``STRIDE``) that hold a digit or an at sign."""
    hot = np.nonzero((cls == _DIGIT) | (cls == _AT))[0]
    k = hot // STRIDE
    return np.unique(np.concatenate((k, np.maximum(k - (WINDOW // STRIDE - 1), 0)))) * STRIDE


def cut_windows(cls: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate((cls, np.zeros(WINDOW, np.uint8)))
    return padded[starts[:, None] + np.arange(WINDOW)]


def tags_of(length: int, spans) -> np.ndarray:
    tags = np.zeros(length + WINDOW, np.uint8)
    for kind, a, b in spans:
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    return tags


#: Places of the chains decoded together, padding included; chains of more than ``LONG``
#: places are decoded in blocks of ``BLOCK``.
CELLS, LONG, BLOCK = 1 << 18, 1 << 15, 512


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class Model:
    """Embedding -> LSTM in both directions -> emissions -> CRF, trained by Adam."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def fresh(cls, seed: int = SEED) -> Model:
        r, k = np.random.default_rng(seed), len(TAGS)
        p = {"embed": r.normal(0, 0.5, (_CLASSES, EMBED)), "out": r.normal(0, 0.3, (2 * HIDDEN, k)), "bias": np.zeros(k),
             "trans": np.zeros((k, k))}
        for d in "fb":
            p["x" + d] = r.normal(0, 0.4, (EMBED, 4 * HIDDEN))
            p["h" + d] = r.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
            p["c" + d] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
        return cls({n: v.astype(np.float32) for n, v in p.items()})

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (T, N, H) for class ids (T, N), already in reading order."""
        p, H = self.p, HIDDEN
        fed = p["embed"] @ p["x" + d] + p["c" + d]
        h = c = np.zeros((x.shape[1], H), np.float32)
        hs, saved = np.empty((*x.shape, H), np.float32), []
        for t in range(len(x)):
            z = fed[x[t]] + h @ p["h" + d]
            g = np.empty_like(z)
            g[:, :3 * H] = 0.5 * (1 + np.tanh(0.5 * z[:, :3 * H]))  # input, forget, output gates
            g[:, 3 * H:] = np.tanh(z[:, 3 * H:])
            before = c
            c = g[:, H:2 * H] * c + g[:, :H] * g[:, 3 * H:]
            th = np.tanh(c)
            if keep:
                saved.append((g, before, th, h))
            h = g[:, 2 * H:3 * H] * th
            hs[t] = h
        return hs, saved

    def emissions(self, windows: np.ndarray, keep: bool = False):
        """(N, T, tags) for class ids (N, T)."""
        x = windows.T
        forward, s1 = self._lstm(x, "f", keep)
        backward, s2 = self._lstm(x[::-1], "b", keep)
        both = np.concatenate((forward, backward[::-1]), axis=2)
        em = (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)
        return (em, both, s1, s2) if keep else em

    def _lstm_grad(self, x, dh, saved, d, grads):
        p, H = self.p, HIDDEN
        all_dz = np.empty((*x.shape, 4 * H), np.float32)
        dwh, carry_h, carry_c = np.zeros_like(p["h" + d]), 0.0, 0.0
        for t in range(len(x) - 1, -1, -1):
            g, before, th, h = saved[t]
            i, f, o, u = g[:, :H], g[:, H:2 * H], g[:, 2 * H:3 * H], g[:, 3 * H:]
            dht = dh[t] + carry_h
            dc = dht * o * (1 - th * th) + carry_c
            dz = np.concatenate((dc * u * i * (1 - i), dc * before * f * (1 - f), dht * th * o * (1 - o), dc * i * (1 - u * u)), axis=1)
            all_dz[t] = dz
            dwh += h.T @ dz
            carry_h, carry_c = dz @ p["h" + d].T, dc * f
        dx = np.eye(_CLASSES, dtype=np.float32)[x.ravel()].T @ all_dz.reshape(-1, 4 * H)
        grads["h" + d], grads["c" + d] = dwh, dx.sum(axis=0)
        grads["x" + d] = p["embed"].T @ dx
        grads["embed"] = grads.get("embed", 0) + dx @ p["x" + d].T

    def step(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log-likelihood per window and its gradients."""
        N, T = windows.shape
        em, both, s1, s2 = self.emissions(windows, keep=True)
        trans, k = self.p["trans"], len(TAGS)
        alpha, beta = np.empty_like(em), np.zeros_like(em)
        alpha[:, 0] = em[:, 0]
        for t in range(1, T):
            alpha[:, t] = em[:, t] + _logsum(alpha[:, t - 1, :, None] + trans, 1)
        for t in range(T - 2, -1, -1):
            beta[:, t] = _logsum(trans + (em[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _logsum(alpha[:, -1], 1)
        dem = np.exp(alpha + beta - total[:, None, None])
        pair = np.zeros((k, k))
        for t in range(1, T):
            pair += np.exp(alpha[:, t - 1, :, None] + trans + (em[:, t] + beta[:, t])[:, None, :] - total[:, None, None]).sum(axis=0)
        n, at = np.arange(N)[:, None], np.arange(T)
        gold = em[n, at, tags].sum() + trans[tags[:, :-1], tags[:, 1:]].sum()
        dem[n, at, tags] -= 1
        np.subtract.at(pair, (tags[:, :-1], tags[:, 1:]), 1)
        dem = (dem / N).transpose(1, 0, 2).astype(np.float32)
        grads = {"trans": pair / N, "out": np.tensordot(both, dem, ((0, 1), (0, 1))), "bias": dem.sum(axis=(0, 1))}
        dboth, x = dem @ self.p["out"].T, windows.T
        self._lstm_grad(x, dboth[:, :, :HIDDEN], s1, "f", grads)
        self._lstm_grad(x[::-1], dboth[::-1, :, HIDDEN:], s2, "b", grads)
        return float(total.sum() - gold) / N, grads

    def fit(self, windows: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.03, seed: int = SEED) -> Model:
        r, moments, k = np.random.default_rng(seed), {n: (0.0, 0.0) for n in self.p}, 0
        for epoch in range(epochs):
            order = r.permutation(len(windows))
            for i in range(0, len(order), batch):
                _, grads = self.step(windows[order[i:i + batch]], tags[order[i:i + batch]])
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                k += 1
                for name, g in grads.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    m, v = moments[name]
                    m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
                    moments[name] = m, v
                    self.p[name] = (self.p[name] - rate * 0.7 ** epoch * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-6)).astype(np.float32)
        return self

    def decode(self, em: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Best tags of stretches: em (N, T, tags), the first ``lengths`` places count."""
        N, T, k = em.shape
        trans, score, back = self.p["trans"], em[:, 0].copy(), np.zeros((T, N, k), np.uint8)
        for t in range(1, T):
            all_ = score[:, :, None] + trans
            back[t] = all_.argmax(axis=1)
            new = all_.max(axis=1) + em[:, t]
            score = np.where((t < lengths)[:, None], new, score)
        best, out = score.argmax(axis=1), np.zeros((N, T), np.uint8)
        rows = np.arange(N)
        for t in range(T - 1, -1, -1):
            inside = t < lengths
            out[inside, t] = best[inside]
            best = np.where(inside, back[t][rows, best], best)
        return [out[i, :n] for i, n in enumerate(lengths)]


_NEAR = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW)).astype(np.float32) + 1.0


def stretches(em: np.ndarray, starts: np.ndarray):
    """(start, emissions) of each chain of overlapping windows of one text."""
    breaks = np.nonzero(np.diff(starts) >= WINDOW)[0] + 1
    for part in np.split(np.arange(len(starts)), breaks):
        first = starts[part[0]]
        size = starts[part[-1]] - first + WINDOW
        total, weight = np.zeros((size, em.shape[2]), np.float32), np.zeros((size, 1), np.float32)
        for i in part:
            a = starts[i] - first
            total[a:a + WINDOW] += em[i] * _NEAR[:, None]
            weight[a:a + WINDOW] += _NEAR[:, None]
        yield first, total / weight


def segments(model: Model, cls: np.ndarray, starts: np.ndarray):
    """The emissions of one chain of windows, as ``stretches`` averages them, piece by piece."""
    tail, weight = np.zeros((0, len(TAGS)), np.float32), np.zeros((0, 1), np.float32)
    for k in range(0, len(starts), 256):
        part = starts[k:k + 256]
        size = int(part[-1] - part[0]) + WINDOW
        total, near = np.zeros((size, len(TAGS)), np.float32), np.zeros((size, 1), np.float32)
        total[:len(tail)], near[:len(tail)] = tail, weight
        for a, em in zip((part - part[0]).tolist(), model.emissions(cut_windows(cls, part))):
            total[a:a + WINDOW] += em * _NEAR[:, None]
            near[a:a + WINDOW] += _NEAR[:, None]
        done = int(starts[k + 256] - part[0]) if k + 256 < len(starts) else size
        yield total[:done] / near[:done]
        tail, weight = total[done:], near[done:]


def _rows(em: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A piece of a chain as rows of ``BLOCK`` places (the last one may be shorter)."""
    n = -(-len(em) // BLOCK)
    lengths = np.minimum(BLOCK, len(em) - BLOCK * np.arange(n))
    rows = np.zeros((n * BLOCK, em.shape[1]), np.float64)
    rows[:len(em)] = em
    return rows.reshape(n, BLOCK, -1), lengths


def decode_long(model: Model, cls: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Best tags of one chain of windows of any length.

    A first pass keeps one max-plus matrix per ``BLOCK`` places and finds from
    these the tags at the blocks' ends; a second decodes each block between
    them. Emissions are made piece by piece in both, so a chain of n places
    holds about 2 n bytes."""
    trans, moves = model.p["trans"].astype(np.float64), []
    for em in segments(model, cls, starts):
        rows, lengths = _rows(em)
        move = trans + rows[:, 0][:, None, :]
        if not moves:  # the chain begins here: nothing is entered from
            move[0] = rows[0, 0]
        for t in range(1, int(lengths.max())):
            nxt = (move[:, :, :, None] + trans).max(axis=2) + rows[:, t][:, None, :]
            move = np.where((t < lengths)[:, None, None], nxt, move)
        moves.append(move)
    moves = np.concatenate(moves)
    score, back = moves[0][0], []
    for move in moves[1:]:
        step = score[:, None] + move
        back.append(step.argmax(axis=0))
        score = step.max(axis=0)
    leave = [int(score.argmax())]
    for b in reversed(back):
        leave.append(int(b[leave[-1]]))
    leave = np.array(leave[::-1])
    out, at = [], 0
    for em in segments(model, cls, starts):
        rows, lengths = _rows(em)
        n, every = len(rows), np.arange(len(rows))
        score = rows[:, 0] + np.array([trans[leave[i - 1]] if i else np.zeros(len(TAGS)) for i in range(at, at + n)])
        pointers = np.zeros((BLOCK, n, len(TAGS)), np.uint8)
        for t in range(1, int(lengths.max())):
            step = score[:, :, None] + trans
            pointers[t] = step.argmax(axis=1)
            score = np.where((t < lengths)[:, None], step.max(axis=1) + rows[:, t], score)
        best, tags = leave[at:at + n], np.zeros((n, BLOCK), np.uint8)
        for t in range(BLOCK - 1, -1, -1):
            inside = t < lengths
            tags[inside, t] = best[inside]
            if t:
                best = np.where(inside, pointers[t][every, best], best)
        out.append(tags[np.arange(BLOCK)[None, :] < lengths[:, None]])
        at += n
    return np.concatenate(out)


def tagged_spans(tags: np.ndarray, start: int) -> list[tuple[int, int, int]]:
    """(kind, start, end) of runs of one kind; a B tag begins a new run."""
    kind = np.where(tags > 0, (tags.astype(np.int8) - 1) // 2, -1).astype(np.int8)
    begins = (kind >= 0) & ((tags % 2 == 1) | (np.concatenate(([-1], kind[:-1])) != kind))
    out = []
    for a in np.nonzero(begins)[0]:
        b = a + 1
        while b < len(kind) and kind[b] == kind[a] and not begins[b]:
            b += 1
        out.append((int(kind[a]), start + int(a), start + int(b)))
    return out


def plausible(kind: int, value: str) -> bool:
    """Least evidence that an added span must hold."""
    digits = sum(c in "0123456789" for c in value)
    if kind == 0:
        return value.count("@") == 1 and 0 < value.index("@") < len(value) - 3 and not any(c.isspace() for c in value)
    if kind == 1:
        return value.count(".") >= 3 and digits >= 4 and value[0].isdigit() and value[-1].isdigit()
    if kind == 2:
        return 13 <= digits <= 19 and value[0].isdigit() and value[-1].isdigit()
    return 7 <= digits <= 15 and value[0] in "+(0123456789" and value[-1].isdigit() and any(c in " ()-." for c in value)


def _groups(chains: list[np.ndarray], most: int):
    """Chains in runs of about ``most`` windows."""
    group, size = [], 0
    for c in chains:
        group.append(c)
        size += len(c)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def added_spans(model: Model, texts: list[str], bases: list[list]) -> list[list[tuple[int, int, int]]]:
    """Model spans of each text that touch no base span."""
    found: list[list] = [[] for _ in texts]
    jobs = [(i, c, s) for i, t in enumerate(texts) if t and len(s := starts_of(c := classes(t)))]
    held = []

    def keep(i, tags, first):
        for kind, a, b in tagged_spans(tags, first):
            b = min(b, len(texts[i]))
            if a < b and plausible(kind, texts[i][a:b]) and not any(x < b and a < y for _, x, y in bases[i]):
                found[i].append((kind, a, b))

    def flush():
        held.sort(key=lambda h: len(h[2]))
        k = 0
        while k < len(held):  # chains of like length, at most CELLS places with their padding
            stop = k + 1
            while stop < len(held) and (stop + 1 - k) * len(held[stop][2]) <= CELLS:
                stop += 1
            part, k = held[k:stop], stop
            lengths = np.array([len(e) for _, _, e in part])
            em = np.zeros((len(part), lengths.max(), len(TAGS)), np.float32)
            for row, (_, _, e) in zip(em, part):
                row[:len(e)] = e
            for (i, first, _), tags in zip(part, model.decode(em, lengths)):
                keep(i, tags, first)
        held.clear()

    for i, cls, starts in jobs:
        chains = np.split(starts, np.nonzero(np.diff(starts) >= WINDOW)[0] + 1)
        for chain in [c for c in chains if c[-1] - c[0] + WINDOW > LONG]:
            keep(i, decode_long(model, cls, chain), int(chain[0]))
        chains = [c for c in chains if c[-1] - c[0] + WINDOW <= LONG]
        for group in _groups(chains, 512):
            some = np.concatenate(group)
            held.extend((i, int(a), e) for a, e in stretches(model.emissions(cut_windows(cls, some)), some))
            if sum(len(h[2]) for h in held) > 200_000:
                flush()
        if sum(len(h[2]) for h in held) > 200_000:
            flush()
    flush()
    return found


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs_bound: int = TRAIN_DOCS,
          windows_bound: int = TRAIN_WINDOWS) -> Model | None:
    """Fits the model on windows of at most ``docs_bound`` documents, labelled by
    the base spans; the choice goes by hash, so it is the same in each run.
    None if no document holds a digit or an at sign."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs_bound)

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cls = classes(text)
                starts, tags = starts_of(cls), tags_of(len(text), base_spans(text))
                for s, w in zip(starts.tolist(), cut_windows(cls, starts)):
                    for column, v in zip(out, (doc, s, w.tobytes(), tags[s:s + WINDOW].tobytes())):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                                              pa.array(out[3], pa.binary())], names=["doc_id", "start", "window", "tags"])

    key = F.coalesce("doc_id", F.lit(-1))  # at most docs_bound ids are broadcast
    found = rows.join(F.broadcast(chosen.select(key.alias("chosen"))), key == F.col("chosen"), "left_semi")
    sample = (found.mapInArrow(run, "doc_id long, start long, window binary, tags binary")
              .orderBy(F.xxhash64("doc_id", "start", "window"), "window", "tags").limit(windows_bound).collect())
    if not sample:
        return None
    return Model.fresh().fit(np.array([np.frombuffer(r["window"], np.uint8) for r in sample]),
                             np.array([np.frombuffer(r["tags"], np.uint8) for r in sample]))


def find(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per input row: doc_id, base and found: arrays of (kind, start, end)
    by kind as listed, then start; found holds the base spans and the added ones.

    Starts and ends are code points, ends exclusive. Null and empty texts have
    no spans; repeated rows get equal rows; a null id stays null; an empty
    table gives an empty result; other columns are not read. Very long texts are
    read whole; memory is some ten bytes a character of the longest one, not
    its length times the number of others.
    """
    model = model or train(docs, id_col, text_col)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(spans):
            return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)]

        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                batch = whole.slice(i, 1000)
                texts = batch.column(1).to_pylist()
                bases = [base_spans(t) for t in texts]
                more = added_spans(model, texts, bases) if model else [[]] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([told(b) for b in bases], span), pa.array([told(b + m) for b, m in zip(bases, more)], span)],
                    names=["doc_id", "base", "found"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"doc_id long, base {kind}, found {kind}")
