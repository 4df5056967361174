"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The vocabulary and its scores come from a given model file; the merging is done here, because the skipping of merges has to
depend on a key and not on a random generator. Merges wait on an agenda, best score first, leftmost on ties. When one
is taken up, a keyed hash of (seed, variant of the document, word, place, merged piece) decides whether it is skipped
for good. Other merges go on, so one word has many segmentations, and every rerun gives the same ones.

No piece crosses a space or a line break (checked when the vocabulary is read), so words are encoded on their own and
their ids are kept in a bounded cache. The new words of a chunk are segmented together: their agendas are the rows of one
array, and each step takes up the best merge of every row. Words beyond ``WIDTHS`` have an agenda of their own. Characters outside the vocabulary become byte pieces; so does a literal
U+2581, which as a piece would read as a space. Decoding is therefore exact for every text.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import chunks

MODEL = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7
#: Documents are dealt over so many keys; the same word is segmented alike under one key.
VARIANTS = 8
#: Words that a worker keeps, about 250 bytes each. Workers outlive their tasks, so later stages of a pipeline run beside them.
CACHE_WORDS = 200_000
CHUNK_BYTES = 4 << 20
#: Words up to these lengths share an array, ``BLOCK_WORDS`` at a time.
WIDTHS = (6, 9, 12, 16, 24, 48)
BLOCK_WORDS = 8192
BLOCK_IDS = 1 << 18
NEVER = np.iinfo(np.int32).max
MARK = "▁"
_UNITS = re.compile("\n|▁*[^▁\n]+|▁+")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Vocabulary of a model file, with encoding and decoding of single texts."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.bytes: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                if "\n" in piece or MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses words; words can't be encoded one by one")
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.bytes.append(piece.replace(MARK, " ").encode())
        if not all(self.byte_ids):
            raise ValueError("the model has no byte pieces, so decoding can't be lossless")
        self._tables()

    def _tables(self) -> None:
        """Merges as arrays. Symbols are piece ids; a character that is no piece is the number of pieces and its code point."""
        size = len(self.bytes)
        symbol = np.arange(size, size + 0x110000, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                symbol[ord(piece)] = i
        part = lambda x: self.ids.get(x, int(symbol[ord(x)]) if len(x) == 1 else None)
        steps = {s: k for k, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        merges = sorted(
            (left << 32 | right, i, steps[self.scores[piece]])
            for piece, i in self.ids.items() for cut in range(1, len(piece))
            if (left := part(piece[:cut])) is not None and (right := part(piece[cut:])) is not None)
        pairs, into, order = zip(*merges) if merges else ((), (), ())
        self.symbol, self.size = symbol, size
        self.into, self.order = np.array([*into, 0], np.int64), np.array([*order, NEVER], np.int32)
        # Open addressing: an empty slot holds no pair and the last, empty merge.
        bits = max(8, 3 + len(pairs).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64)
        self.places = np.full(1 << bits, len(pairs), np.int32)
        for place, (pair, slot) in enumerate(zip(pairs, self._slot(np.array(pairs, np.int64)).tolist())):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & (1 << bits) - 1
            self.slots[slot], self.places[slot] = pair, place
        self.byte_array = np.array(self.byte_ids, np.int32)
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.widths = np.fromiter(map(len, self.bytes), np.int64, size)
        self.starts = np.cumsum(self.widths) - self.widths

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _find(self, pairs: np.ndarray) -> np.ndarray:
        """Place of each pair's merge; the last place where there is none."""
        slot = self._slot(pairs)
        held = self.slots[slot]
        while len(on := np.flatnonzero((held != pairs) & (held >= 0))):
            slot[on] = (slot[on] + 1) & len(self.slots) - 1
            held[on] = self.slots[slot[on]]
        return self.places[slot]

    def segment_all(self, words: list[str], bases: np.ndarray, dropout: float) -> list[bytes]:
        """Packed ids of each word, as ``segment`` gives them. ``bases``: the words' keyed hashes."""
        out = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            for start in range(0, len(rows), BLOCK_WORDS):
                at = rows[start:start + BLOCK_WORDS]
                for i, ids in zip(at.tolist(), self._block([words[i] for i in at.tolist()], lengths[at], bases[at], width, dropout)):
                    out[i] = ids
            low = width
        for i in np.flatnonzero(lengths > low).tolist():
            out[i] = np.array(self.segment(words[i], int(bases[i]), dropout), np.int32).tobytes()
        return out

    def _block(self, words: list[str], lengths: np.ndarray, bases: np.ndarray, width: int, dropout: float) -> list[bytes]:
        limit = np.uint64(int(dropout * (1 << 32)))
        n = len(words)
        inside = np.arange(width) < lengths[:, None]
        symbols = np.full((n, width), -1, np.int64)
        symbols[inside] = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        symbols = symbols.ravel()
        after, before = np.tile(np.arange(1, width + 1), n), np.tile(np.arange(-1, width - 1), n)
        ends = np.repeat(lengths, width)
        order, into = np.full(n * width, NEVER, np.int32), np.zeros(n * width, np.int64)

        def put(at: np.ndarray, right: np.ndarray) -> None:
            """Merge of ``at`` with the symbol at ``right`` on the agenda, unless there is none or its hash skips it."""
            found = self._find(symbols[at] << 32 | symbols[right])
            hit = found < len(self.into) - 1
            order[at] = NEVER
            at, found = at[hit], found[hit]
            merged = self.into[found]
            if limit:
                h = bases[at // width] ^ ((at % width).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) \
                    ^ (merged.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                taken = h >> np.uint64(32) >= limit
                at, found, merged = at[taken], found[taken], merged[taken]
            order[at], into[at] = self.order[found], merged

        first = np.flatnonzero((np.arange(1, width + 1) < lengths[:, None]).ravel())
        put(first, first + 1)
        agenda, alive = order.reshape(n, width), np.arange(n)
        while True:
            best = agenda[alive].argmin(axis=1)
            at = alive * width + best
            some = order[at] < NEVER
            alive, at = alive[some], at[some]
            if not len(alive):
                break
            start = alive * width
            gone = start + after[at]
            symbols[at] = into[at]
            symbols[gone], order[gone], order[at] = -1, NEVER, NEVER
            after[at] = after[gone]
            k = after[at]
            more = k < ends[at]
            right = start[more] + k[more]
            before[right] = at[more] - start[more]
            put(at[more], right)
            k = before[at]
            more = k >= 0
            put(start[more] + k[more], at[more])
        kept = symbols >= 0
        ids, per_word = symbols[kept], kept.reshape(n, width).sum(axis=1)
        unknown = ids >= self.size
        if unknown.any():
            codes = ids[unknown] - self.size
            spread = np.ones(len(ids), np.int64)
            spread[unknown] = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
            text = codes.astype(np.uint32).tobytes().decode("utf-32-le").encode()
            per_word = np.add.reduceat(spread, np.cumsum(per_word) - per_word)
            ids, unknown = np.repeat(ids, spread), np.repeat(unknown, spread)
            ids[unknown] = self.byte_array[np.frombuffer(text, np.uint8)]
        packed, stops = ids.astype(np.int32).tobytes(), (4 * np.cumsum(per_word)).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def segment(self, word: str, base: int, dropout: float) -> list[int]:
        """Ids of one word (spaces as marks). ``base``: the word's keyed hash."""
        parts: list[str | None] = list(word)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        scores, ids = self.scores, self.ids
        agenda = []
        for i in range(n - 1):
            s = scores.get(parts[i] + parts[i + 1])
            if s is not None:
                agenda.append((-s, i, parts[i], parts[i + 1]))
        heapq.heapify(agenda)
        limit = int(dropout * (1 << 32))
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one of them has been merged meanwhile
            merged = left + right
            if limit:
                h = (base ^ (i * 0x9E3779B97F4A7C15) ^ (ids[merged] * 0xC2B2AE3D27D4EB4F)) & 0xFFFFFFFFFFFFFFFF
                h = ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
                if h >> 32 < limit:
                    continue
            parts[i], parts[j] = merged, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                s = scores.get(merged + parts[k])
                if s is not None:
                    heapq.heappush(agenda, (-s, i, merged, parts[k]))
            k = before[i]
            if k >= 0:
                s = scores.get(parts[k] + merged)
                if s is not None:
                    heapq.heappush(agenda, (-s, k, parts[k], merged))
        out: list[int] = []
        for part in parts:
            if part is not None:
                found = ids.get(part)
                out.extend([found] if found is not None else [self.byte_ids[b] for b in part.encode()])
        return out

    def decode(self, ids) -> bytes:
        """UTF-8 bytes of a whole encoded text."""
        ids, parts = np.asarray(ids, np.int64), []
        for start in range(0, len(ids), BLOCK_IDS):
            block = ids[start:start + BLOCK_IDS]
            width = self.widths[block]
            place = np.repeat(self.starts[block] - (np.cumsum(width) - width), width)
            parts.append(self.blob[place + np.arange(len(place))].tobytes())
        whole = b"".join(parts)
        return whole[1:] if whole[:1] == b" " else whole


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def encoder_of(path: str, dropout: float, seed: int, variants: int) -> Encoder:
    """One encoder for all tasks of a worker, so that its cached words are used again."""
    return Encoder(path, dropout, seed, variants)


class Encoder:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS):
        self.pieces = load(path)
        keys = [xxhash.xxh3_64_intdigest(f"{seed}-{v}".encode()) for v in range(variants)]
        self.keys, self.dropout = keys, dropout
        self.mark = np.array([self.pieces.byte_ids[b] for b in MARK.encode()], np.int32).tobytes()
        #: For each variant: words -> packed ids; a literal mark is None.
        self.caches: list[dict[str | None, bytes]] = [{None: self.mark} for _ in keys]

    @staticmethod
    def _units(text: str) -> list[str | None]:
        """Words of a text with spaces as marks, and None for each literal mark. An empty text has none; any other starts with a mark."""
        if not text:
            return []
        if MARK not in text:
            return _UNITS.findall((" " + text).replace(" ", MARK))
        units: list[str | None] = []
        for span in (" " + text).split(MARK):
            units += [*_UNITS.findall(span.replace(" ", MARK)), None]
        return units[:-1]

    def packed(self, texts: list[str], variants: list[int]) -> list[bytes]:
        """Ids of whole texts as packed int32."""
        units = list(map(self._units, texts))
        variants = [v % len(self.caches) for v in variants]
        words: list[str] = []
        bases: list[int] = []
        new: list[tuple[int, int]] = []
        for v, (cache, key) in enumerate(zip(self.caches, self.keys)):
            met = set(itertools.chain.from_iterable(u for u, of in zip(units, variants) if of == v))
            fresh = met - cache.keys()
            if len(cache) + len(fresh) > CACHE_WORDS // len(self.caches) and len(fresh):
                cache.clear()
                cache[None] = self.mark
                fresh = met - {None}
            words += fresh
            bases += [xxhash.xxh3_64_intdigest(w.encode(), key) for w in fresh] if self.dropout else [0] * len(fresh)
            new.append((v, len(fresh)))
        ids = iter(zip(words, self.pieces.segment_all(words, np.array(bases, np.uint64), self.dropout)))
        for v, n in new:
            self.caches[v].update(itertools.islice(ids, n))
        return [b"".join(map(self.caches[v].__getitem__, u)) for u, v in zip(units, variants)]


def _variant(id_column: str, variants: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{id_column}`")), F.lit(variants)).cast("int")


def _given(df: DataFrame, id_column: str, text_column: str, variants: int) -> tuple[Column, Column]:
    return F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"), _variant(id_column, variants).alias("variant")


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", ids_column: str = "input_ids", dropout: float = DROPOUT,
    seed: int = SEED, variants: int = VARIANTS, path: str | None = None,
) -> DataFrame:
    """All columns of ``df`` and the ids of each text. A column of that name is replaced. Null and empty texts have no ids.

    Rows without an id share one variant; repeated rows are encoded alike.
    """
    path = path or model_path()
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() != ids_column.lower()])
    given = df.select(row.alias("row"), *_given(df, id_column, text_column, variants))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, dropout, seed, variants)
        for chunk in chunks(batches, CHUNK_BYTES):
            parts = encoder.packed(chunk.column(1).to_pylist(), chunk.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([chunk.column(0), _lists(parts)], names=["row", "ids"])

    out = given.mapInArrow(run, f"row {given.schema['row'].dataType.simpleString()}, ids array<int>")
    return out.select("row.*", F.col("ids").alias(ids_column))


def decode(df: DataFrame, ids_column: str = "input_ids", text_column: str = "decoded", path: str | None = None) -> DataFrame:
    """All columns of ``df`` and the text of the ids. A null or empty list is an empty text."""
    path = path or model_path()
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() != text_column.lower()])
    given = df.select(row.alias("row"), F.col(f"`{ids_column}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for chunk in chunks(batches, CHUNK_BYTES):
            texts = [pieces.decode(ids or []).decode() for ids in chunk.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = given.mapInArrow(run, f"row {given.schema['row'].dataType.simpleString()}, text string")
    return out.select("row.*", F.col("text").alias(text_column))


def round_trip(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", dropout: float = DROPOUT, seed: int = SEED,
    variants: int = VARIANTS, path: str | None = None,
) -> DataFrame:
    """Encode and decode every text in the same task: doc_id, n_ids, n_byte_ids, ids_sha256, decoded_sha256, lossless."""
    path = path or model_path()
    kind = df.schema[id_column].dataType.simpleString()
    given = df.select(F.col(f"`{id_column}`").alias("doc_id"), *_given(df, id_column, text_column, variants))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, dropout, seed, variants)
        is_byte = np.zeros(len(encoder.pieces.bytes), bool)
        is_byte[encoder.pieces.byte_ids] = True
        for chunk in chunks(batches, CHUNK_BYTES):
            rows = []
            texts = chunk.column(1).to_pylist()
            for text, packed in zip(texts, encoder.packed(texts, chunk.column(2).to_pylist())):
                ids = np.frombuffer(packed, np.int32)
                back = encoder.pieces.decode(ids)
                rows.append((len(ids), int(is_byte[ids].sum()), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest(),
                             back == text.encode()))
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())))],
                names=["doc_id", "n_ids", "n_byte_ids", "ids_sha256", "decoded_sha256", "lossless"])

    return given.mapInArrow(
        run, f"doc_id {kind}, n_ids long, n_byte_ids long, ids_sha256 string, decoded_sha256 string, lossless boolean")
