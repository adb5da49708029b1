"""Vector bin packing of tokenised examples into training sequences.

An example is a list of segments, each with text and a flag whether its
tokens bear loss. A sequence has three limits at once: tokens, segments
(pieces) and loss-bearing tokens. Examples are cut at whole sequences first
(a full sequence has no padding), and what is left over is packed by the
dot-product heuristic: of the pieces that fit, the sequence takes the one
whose demand vector has the largest dot product with the room that is left,
so a piece goes where it uses what is plentiful. If none fits, the best
piece is cut to fill the sequence. The last sequence of a partition is split
at powers of two, which need no padding.

Packing runs where the rows are read, over a pool of bounded size: nothing is
shuffled and a lost task is redone from its own input split.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

TOKENS = 4096
SEGMENTS = 256
#: Tokens at the end of each example (loss-bearing).
END = (2,)
#: Remainders held while a partition is packed, and word pieces kept per worker.
POOL = 1024
CACHE = 1_000_000
#: Characters of the texts whose words are learned together.
CHUNK = 1 << 21

SCHEMA = ("doc_id long, start long, length long, loss_tokens long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


class WordTokenizer:
    """Ids of texts from a tokenizer file, with the ids of words kept.

    The tokenizer lower-cases, splits at white space and treats each word on
    its own, so a text's ids are those of its words in a row. Texts with
    characters whose case or class depends on the Unicode version, or with the
    name of a special token, go through the tokenizer whole.
    """

    #: Latin letters, digits, punctuation and plain spaces; lower-casing and
    #: normal form C act on each of them alone (or not at all).
    plain = regex.compile(r"[\t\n\r\x20-\x7e\u00a1-\u012f\u0131-\u024f\u2010-\u2027]*+")
    #: The same for Latin-1 bytes, which most texts fit.
    bytes_plain = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])
    bytes_lower = bytes(ord(chr(c).lower()) if c != 0xDF else c for c in range(256))
    #: The tokenizer's own rule for pieces of a word; each piece's last id is a word end.
    piece = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)  # for words that are lower-cased and split already
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        vocab = self.model.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for word, i in vocab.items() if word.endswith("</w>")]] = True
        self.words: dict[str | bytes, bytes] = {}  # in use since the last change of generations
        self.older: dict[str | bytes, bytes] = {}  # the generation before

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts; words that are new to all of them are learned at once."""
        split = [self._words(t) for t in texts]
        here = set().union(*(w for w in split if not isinstance(w, bytes)))
        new = here - self.words.keys()
        if len(self.words) + len(new) > CACHE // 2:  # words met again move on from the older generation
            self.older, self.words, new = self.words, {}, here
        again = new & self.older.keys()
        self.words.update((w, self.older[w]) for w in again)
        fresh = list(new - again)
        for i in range(0, len(fresh), 8192):
            self._learn(fresh[i:i + 8192])
        return [w if isinstance(w, bytes) else b"".join(map(self.words.__getitem__, w)) for w in split]

    def _words(self, text: str) -> list | bytes:
        """The lower-cased words of a plain text; the ids at once of any other."""
        try:
            latin = text.encode("latin-1")
            plain = not latin.translate(None, self.bytes_plain)
        except UnicodeEncodeError:
            latin, plain = None, self.plain.fullmatch(text)
        if not plain or any(s in text for s in self.special):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return text.lower().split() if latin is None else latin.translate(self.bytes_lower).split()

    def _split(self, word: str) -> list[str]:
        """The pieces of a word; letters with at most one mark behind them need no search."""
        if word.isalpha():
            return [word]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.piece.findall(word)

    def _learn(self, words: list[str | bytes]) -> None:
        """Ids of many words by one call: each piece (once, however many words hold it) ends with its word end."""
        pieces = [self._split(w if isinstance(w, str) else w.decode("latin-1")) for w in words]
        distinct = list(dict.fromkeys(itertools.chain.from_iterable(pieces)))
        ids = np.array(self.bare.encode_batch_fast([" ".join(distinct)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.nonzero(self.ends[ids])[0] + 1
        if len(ends) != len(distinct):
            raise ValueError("the tokenizer splits words in another way")
        raw, stops = ids.tobytes(), (4 * ends).tolist()
        known = {p: raw[start:stop] for p, start, stop in zip(distinct, [0, *stops], stops)}
        self.words.update((w, known[p[0]] if len(p) == 1 else b"".join(map(known.__getitem__, p))) for w, p in zip(words, pieces))


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    if path not in _tokenizers:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _bears(loss: np.ndarray | None, start: int, stop: int) -> int:
    """Loss-bearing tokens from ``start`` to ``stop``; None: all of them are."""
    return stop - start if loss is None else int(loss[stop] - loss[start])


def _reach(loss: np.ndarray | None, start: int, most: int) -> int:
    """The last place up to which at most ``most`` tokens from ``start`` bear loss."""
    return start + int(most) if loss is None else int(np.searchsorted(loss, loss[start] + most, "right")) - 1


def _cut(loss: np.ndarray | None, start: int, stop: int) -> np.ndarray | None:
    return None if loss is None else loss[start:stop + 1]


class _Packer:
    """Packs pieces (doc, start, ids, loss prefix sums or None, total) into sequences."""

    def __init__(self, limits: tuple[int, int, int], pool: int, first: int):
        self.limits, self.pool, self.next = np.array(limits, float), pool, first
        self.need = np.zeros((pool, 3))  # tokens, segments, loss tokens; 0 tokens: free place
        self.items: list = [None] * pool
        self.free = list(range(pool))
        self.out: list = []

    def emit(self, pieces) -> None:
        offset = 0
        for doc, start, ids, loss, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, _bears(loss, 0, n), total, self.next, offset, ids))
            offset += n
        self.next += 1

    def add(self, doc, ids: bytes, loss: np.ndarray | None) -> None:
        """loss: prefix sums, one longer than the ids, or None where all bear loss."""
        total, start = len(ids) // 4, 0
        tokens, _, most = self.limits
        while total - start >= tokens and _bears(loss, start, start + int(tokens)) <= most:
            stop = start + int(tokens)
            self.emit([(doc, start, ids[4 * start:4 * stop], _cut(loss, start, stop), total)])
            start = stop
        while start < total:  # pieces within the limits
            stop = min(total, start + int(tokens), _reach(loss, start, most))
            self.hold((doc, start, ids[4 * start:4 * stop], _cut(loss, start, stop), total))
            start = stop

    def hold(self, piece) -> None:
        if not self.free:
            while len(self.free) < self.pool // 2:
                self.fill()
        k = heapq.heappop(self.free)
        n = len(piece[2]) // 4
        self.items[k], self.need[k] = piece, (n, 1, _bears(piece[3], 0, n))

    def take(self, k: int):
        piece, self.items[k], self.need[k] = self.items[k], None, 0
        heapq.heappush(self.free, k)
        return piece

    def fill(self) -> None:
        """Packs one sequence from the pool."""
        room, pieces, scaled = self.limits.copy(), [], self.need / self.limits
        held = self.need[:, 0] > 0
        while room[0] > 0 and room[1] > 0 and held.any():
            last = room[1] == 1
            score = np.where(held, scaled @ (room / self.limits), -1.0)
            fits = held & (self.need <= room).all(axis=1)
            if last:  # one place: it must fill the rest
                fits &= self.need[:, 0] == room[0]
            if fits.any():
                k = int(np.where(fits, score, -1.0).argmax())
                piece = self.take(k)
            else:
                long = held & (self.need[:, 0] >= room[0])
                k = int(np.where(long, score, -1.0).argmax()) if long.any() else int(score.argmax())
                doc, start, ids, loss, total = self.items[k]
                n = min(len(ids) // 4, int(room[0]), _reach(loss, 0, room[2]))
                if n <= 0:
                    break
                piece = (doc, start, ids[:4 * n], _cut(loss, 0, n), total)
                self.take(k)
                if n < len(ids) // 4:
                    self.free.remove(k)
                    heapq.heapify(self.free)
                    self.items[k] = (doc, start + n, ids[4 * n:], _cut(loss, n, len(ids) // 4), total)
                    self.need[k] = (len(ids) // 4 - n, 1, _bears(loss, n, len(ids) // 4))
                    scaled[k] = self.need[k] / self.limits
            held[k] = self.need[k, 0] > 0
            n = len(piece[2]) // 4
            room -= (n, 1, _bears(piece[3], 0, n))
            pieces.append(piece)
        self.emit(pieces)

    def end(self) -> None:
        """Empties the pool; the last, partly filled sequence is split at powers of two."""
        while (self.need[:, 0] > 0).any():
            if self.need[:, 0].sum() >= self.limits[0]:
                self.fill()
                continue
            rest = [self.take(k) for k in np.nonzero(self.need[:, 0])[0].tolist()]
            while rest:
                left = sum(len(p[2]) // 4 for p in rest)
                size, pieces, loss_room = 1 << (left.bit_length() - 1), [], self.limits[2]
                while size and rest and len(pieces) < self.limits[1]:
                    doc, start, ids, loss, total = rest.pop()
                    n = min(size, len(ids) // 4, _reach(loss, 0, loss_room))
                    if n < len(ids) // 4:
                        rest.append((doc, start + n, ids[4 * n:], _cut(loss, n, len(ids) // 4), total))
                    if n <= 0:
                        break
                    pieces.append((doc, start, ids[:4 * n], _cut(loss, 0, n), total))
                    size, loss_room = size - n, loss_room - _bears(loss, 0, n)
                self.emit(pieces)


def _joined(parts: list[tuple[bytes, bool]]) -> tuple[bytes, np.ndarray]:
    bears = np.repeat([x for _, x in parts], [len(p) // 4 for p, _ in parts])
    return b"".join(p for p, _ in parts), np.concatenate(([0], np.cumsum(bears, dtype=np.int64)))


def _chunks(batch: pa.RecordBatch, plain: bool) -> Iterator[tuple[list, list]]:
    """Rows of a batch in runs of about ``CHUNK`` characters (one row at least)."""
    docs, rows, size = [], [], 0
    for doc, row in zip(batch.column(0), batch.column(1)):
        row = row.as_py()
        docs.append(doc.as_py())
        rows.append(row or "" if plain else row)
        size += len(row or "") if plain else sum(len(x["text"] or "") for x in row or [] if x)
        if size > CHUNK:
            yield docs, rows
            docs, rows, size = [], [], 0
    if docs:
        yield docs, rows


def pack(examples: DataFrame, tokenizer_path: str, id_col: str = "doc_id", segments_col: str = "segments",
         tokens: int = TOKENS, segments: int = SEGMENTS, loss_tokens: int | None = None,
         end: tuple[int, ...] = END, pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, start, length, loss_tokens, doc_tokens, sequence_id, offset, ids.

    ``segments_col`` is an array of (text, loss), or a text that bears loss as a
    whole; a null array or text counts as empty, so such an example still has
    its end token. A sequence holds at
    most ``tokens`` tokens, ``segments`` pieces and ``loss_tokens`` tokens that
    bear loss (default: no limit beside the tokens). Every id of an example
    lies in exactly one piece. Rows that repeat an id are examples of their
    own. Sequences with equal scores are filled in input order; the result
    depends on the input's splits and on nothing else. An empty table gives an
    empty result; other columns are not read.
    """
    limits = (tokens, segments, tokens if loss_tokens is None else loss_tokens)
    if min(limits) < 1:
        raise ValueError("every limit must be 1 at least")
    tail = np.array(end, "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path)
        packer = _Packer(limits, pool, TaskContext.get().partitionId() << 40)

        def flush():
            cols = list(zip(*packer.out)) or [[]] * 8
            packer.out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.binary() if i == 7 else pa.int64()) for i, c in enumerate(cols)],
                names=["doc_id", "start", "length", "loss_tokens", "doc_tokens", "sequence_id", "offset", "ids"])

        size = 0
        for batch in batches:
            plain = pa.types.is_string(batch.schema.field(1).type)
            for docs, rows in _chunks(batch, plain):
                if plain:
                    found = [(ids + tail, None) for ids in tok.ids_of(rows)]
                else:
                    parts = [[(x["text"] or "", bool(x["loss"])) for x in r or [] if x] for r in rows]
                    ids = iter(tok.ids_of([t for p in parts for t, _ in p]))
                    found = [_joined([*((next(ids), bears) for _, bears in p), (tail, True)]) for p in parts]
                for doc, (ids, loss) in zip(docs, found):
                    if len(ids):
                        packer.add(doc, ids, loss)
                    size += len(ids)
                    if size > 1 << 24:
                        yield flush()
                        size = 0
        packer.end()
        yield flush()

    return examples.select(F.col(id_col).cast("long").alias("doc_id"), F.col(segments_col).alias("segments")).mapInArrow(run, SCHEMA)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Plain documents: one segment, all of it bears loss."""
    return pack(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("segments")), tokenizer_path, **options)


def pack_conversations(turns: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Conversations (conv_id, turn, role, text): the assistant's turns bear loss."""
    convs = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text")))), lambda t: F.struct(
            t["text"].alias("text"), (t["role"] == "assistant").alias("loss"))).alias("segments"))
    return pack(convs, tokenizer_path, **options)
