"""SentencePiece encoding and decoding with merge-type vocabularies.

A text becomes a chain of symbols, one per character. All pairs of neighbours whose concatenation
is a piece stand in an agenda ordered by score, equal scores by place. The best pair is merged, and
the pairs it forms with its new neighbours join the agenda, until no pair is left. Symbols that are
no piece are spelled in bytes.

No merge can cross a place where the two characters beside it do not follow one another in any
piece, so a text is cut there and the agenda run on each stretch; stretches repeat, so their ids
are remembered, up to a bounded number: every stretch has a number, and the ids of many texts are
taken by these numbers from one array. The short stretches that are new in a batch are worked off
together: their agendas lie side by side in one array, and each round merges the best pair of every
stretch. Longer ones have a heap each.

Texts are neither cut nor shuffled: one pass of Arrow batches, a bounded number of bytes at a time.
In the same pass the sentencepiece library encodes and decodes the same texts, and ``agrees`` tells
whether both gave the same ids and the same text. The vocabulary file is read once on the driver and
travels with the job, so executors need no copy of it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import astuple, dataclass
from heapq import heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the file format: the space symbol, kinds of pieces, the type of merge models.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2
REPLACEMENT = "�"

#: Stretches up to this many characters are worked off together, longer ones by a heap; the order in
#: which pairs are merged is the same.
SIDE_BY_SIDE_CHARS = 48
#: Stretches of that length that a task remembers, about, and that it works off at a time.
REMEMBERED = 1 << 19
TOGETHER = 1 << 13
#: Bytes of text that are encoded and checked at a time; only memory depends on it.
SLICE = 1 << 20
#: Odd factor of the hash of pairs, 2^64 over the golden ratio.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _fields(buffer: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buffer[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(buffer):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, buffer[at : at + size]
        at += size


@dataclass(frozen=True)
class Vocabulary:
    """What encoding and decoding need of a model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool
    byte_fallback: bool
    unknown_text: str

    @staticmethod
    def parse(model: bytes) -> Vocabulary:
        """Read a model file; anything but plain merges over unchanged text is refused."""
        pieces, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        for number, value in _fields(model):
            if number == 1:
                entry = dict(_fields(value))
                pieces.append(entry[1].decode())
                scores.append(struct.unpack("<f", entry.get(2, bytes(4)))[0])
                kinds.append(entry.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != MERGE_TYPE:
            raise ValueError("not a vocabulary of merges")
        changes = normaliser.get(2, b"") or normaliser.get(4, 1) or not normaliser.get(5, 1)
        if changes or trainer.get(24, 0) or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("only unchanged text and normal pieces are supported")
        return Vocabulary(
            pieces,
            scores,
            kinds,
            bool(normaliser.get(3, 1)),
            bool(trainer.get(35, 0)),
            trainer.get(44, " ⁇ ".encode()).decode(),
        )


class _Numbers(dict):
    """Numbers of stretches. One that is new gets the next number and is noted in ``new``."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.next = 0

    def __missing__(self, stretch: str) -> int:
        self[stretch] = number = self.next
        self.next += 1
        self.new.append(stretch)
        return number


class Encoder:
    """Text to ids by the agenda, and ids to text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.ids: dict[str, int] = {}
        #: Minus the score of every piece: what is least is merged first.
        self.costs: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        self.end = -1
        kinds, linked, crossing = vocabulary.kinds, set(), False
        bytes_of: list[bytes] = []
        for i, (piece, kind) in enumerate(zip(vocabulary.pieces, kinds, strict=True)):
            plain = b""
            if kind == NORMAL:
                self.ids[piece] = i
                self.costs[piece] = -vocabulary.scores[i]
                plain = piece.replace(SPACE, " ").encode()
                if len(piece) > 1:
                    linked.update(piece)
                    crossing = crossing or SPACE in piece.lstrip(SPACE)
            elif kind == BYTE:
                plain = bytes([int(piece[3:5], 16)])
                self.byte_ids[plain[0]] = i
            elif kind == UNKNOWN:
                self.unknown = i
                plain = vocabulary.unknown_text.encode()
            elif piece == "</s>":
                self.end = i
            bytes_of.append(plain)
        self.bytes_of = np.array(bytes_of, dtype=object)
        #: Ids without bytes.
        self.silent = np.array([not plain for plain in bytes_of])
        size = len(kinds)
        #: Ids as decimals with a blank behind, filled up with zero bytes.
        self.decimals = np.array([f"{i} " for i in range(size)], dtype=f"S{len(str(size)) + 1}")
        self.pattern = self._pattern(linked, crossing)
        self._number_pairs()
        self._begin()

    def _pattern(self, linked: set[str], crossing: bool) -> str:
        """A pattern of the stretches that no merge can leave.

        Characters of no longer piece stand alone. Of the others, a run of space symbols begins a
        stretch, and letters end one, unless some piece has a space symbol behind another character,
        or anything but a letter behind a letter.
        """
        rest = linked - {SPACE}
        signs = {c for c in rest if not c.isalpha()}
        follows = any(
            a.isalpha() and not b.isalpha() for piece in self.ids for a, b in zip(piece, piece[1:], strict=False)
        )

        def any_of(characters: set[str]) -> str:
            # Of nothing, no character at all.
            return f"[{re.escape(''.join(sorted(characters)))}]" if characters else "(?:(?!))"

        if crossing:
            return f"{any_of(linked)}++|."
        if follows:
            return f"{SPACE}++{any_of(rest)}*+|{any_of(rest)}++|."
        first, last = any_of(signs), any_of(rest - signs)
        return f"{SPACE}++{first}*+{last}*+|{first}++{last}*+|{last}++|."

    def _begin(self) -> None:
        self.stretches = re.compile(self.pattern, re.DOTALL)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        #: The ids of all remembered stretches, and by number where those of each begin and how many.
        self.pool = np.zeros(0, dtype=np.int32)
        self.begins = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)

    def state(self) -> dict:
        """All but what is remembered, as plain values that travel without this module."""
        remembered = ("stretches", "known", "pool", "begins", "sizes")
        kept = {k: v for k, v in vars(self).items() if k not in remembered}
        return kept | {"vocabulary": astuple(self.vocabulary)}

    @classmethod
    def restored(cls, state: dict) -> Encoder:
        encoder = cls.__new__(cls)
        vars(encoder).update(state, vocabulary=Vocabulary(*state["vocabulary"]))
        encoder._begin()
        return encoder

    def _number_pairs(self) -> None:
        """Symbols as numbers, and a hash table of all pairs that make up a piece.

        A pair lies in the slot of its hash or, if that is taken, in the next free one.
        """
        size = len(self.vocabulary.pieces)
        # A character without a piece has a number beyond the pieces.
        self.symbol_of = np.arange(size, size + 0x110000, dtype=np.int64)
        for piece, number in self.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = number

        def symbol(part: str) -> int | None:
            return int(self.symbol_of[ord(part)]) if len(part) == 1 else self.ids.get(part)

        self.base = size + 0x110000
        pairs = {}
        for piece, number in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = (self.costs[piece], number)
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        # The last slot stays free, so every search ends.
        slots: dict[int, int] = {}
        for key, slot in zip(keys.tolist(), self._slots(keys).tolist(), strict=True):
            while slot in slots:
                slot += 1
            slots[slot] = key
        self.pair_keys = np.full(max([*slots, 1 << bits]) + 2, -1, dtype=np.int64)
        self.pair_costs = np.full(len(self.pair_keys), np.inf)
        self.pair_pieces = np.zeros(len(self.pair_keys), dtype=np.int64)
        for slot, key in slots.items():
            self.pair_keys[slot] = key
            self.pair_costs[slot], self.pair_pieces[slot] = pairs[key]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def _price(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost of merging pairs of symbols (infinite if they make up no piece), and the piece."""
        keys = left * self.base + right
        slots = self._slots(keys)
        held = self.pair_keys[slots]
        others = np.flatnonzero((held != keys) & (held >= 0))
        while len(others):
            slots[others] += 1
            held = self.pair_keys[slots[others]]
            others = others[(held != keys[others]) & (held >= 0)]
        # A search that has found nothing ends in a free slot, which has an infinite cost.
        return self.pair_costs[slots], self.pair_pieces[slots]

    def side_by_side(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol numbers of many stretches, none of them empty, in a row, and where each one ends.

        Each round is a merge in every stretch.
        """
        text = np.frombuffer("".join(stretches).encode("utf-32-le"), dtype=np.uint32)
        symbols = self.symbol_of[text]
        lengths = np.array([len(stretch) for stretch in stretches], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        size = len(symbols)
        before = np.arange(-1, size - 1)
        after = np.arange(1, size + 1)
        before[starts] = -1
        after[starts + lengths - 1] = -1
        costs, pieces = np.full(size, np.inf), np.zeros(size, dtype=np.int64)
        paired = np.flatnonzero(after >= 0)
        costs[paired], pieces[paired] = self._price(symbols[paired], symbols[paired + 1])
        places, row_of, begins = np.arange(size), np.repeat(np.arange(len(stretches)), lengths), starts
        while len(places):
            agenda = costs[places]
            best = np.minimum.reduceat(agenda, begins)
            live = best < np.inf
            if not live.all():
                # Stretches whose agenda is empty are done.
                kept = live[row_of]
                places, agenda, best = places[kept], agenda[kept], best[live]
                row_of = (np.cumsum(live) - 1)[row_of[kept]]
                begins = np.flatnonzero(np.diff(row_of, prepend=-1))
                if not len(places):
                    break
            equal = np.flatnonzero(agenda == best[row_of])
            first = np.diff(row_of[equal], prepend=-1) > 0  # the first of equals
            left = places[equal[first]]
            right = after[left]
            symbols[left], symbols[right] = pieces[left], -1
            costs[left] = costs[right] = np.inf
            after[left] = after[right]
            following = left[after[left] >= 0]
            before[after[following]] = following
            preceding = before[left]
            for ones in (following, preceding[preceding >= 0]):
                costs[ones], pieces[ones] = self._price(symbols[ones], symbols[after[ones]])
        left_over = symbols >= 0
        ends = np.cumsum(np.add.reduceat(left_over, starts, dtype=np.int64))
        return symbols[left_over], ends

    def learn(self, stretches: list[str]) -> None:
        """Remember the ids of stretches, whose numbers follow those so far. Nothing is the end id."""
        begins = np.zeros(len(stretches), dtype=np.int64)
        sizes = np.zeros(len(stretches), dtype=np.int64)
        parts, used = [self.pool], len(self.pool)
        short = []
        for n, stretch in enumerate(stretches):
            if 0 < len(stretch) <= SIDE_BY_SIDE_CHARS:
                short.append(n)
                continue
            ids = np.array(self.merge(stretch) if stretch else [self.end], dtype=np.int32)
            begins[n], sizes[n] = used, len(ids)
            parts.append(ids)
            used += len(ids)
        for at in range(0, len(short), TOGETHER):
            rows = short[at : at + TOGETHER]
            ids, ends = self._spelled_out(*self.side_by_side([stretches[n] for n in rows]))
            counts = np.diff(ends, prepend=0)
            begins[rows], sizes[rows] = used + ends - counts, counts
            parts.append(ids)
            used += len(ids)
        self.pool = np.concatenate(parts)
        self.begins = np.concatenate([self.begins, begins])
        self.sizes = np.concatenate([self.sizes, sizes])

    def _spelled_out(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbol numbers, and where each stretch ends: characters without a piece are spelled."""
        pieces = len(self.vocabulary.pieces)
        rare = np.flatnonzero(numbers >= pieces)
        if not len(rare):
            return numbers.astype(np.int32), ends
        spelled = [self._spelled_ids(chr(number - pieces)) for number in numbers[rare].tolist()]
        counts = np.ones(len(numbers), dtype=np.int64)
        counts[rare] = [len(ids) for ids in spelled]
        behind = np.cumsum(counts)
        ids = np.repeat(numbers, counts)
        ids[ids >= pieces] = list(chain.from_iterable(spelled))
        return ids.astype(np.int32), behind[ends - 1]

    def _spelled_ids(self, character: str) -> list[int]:
        if self.vocabulary.byte_fallback:
            return [self.byte_ids[byte] for byte in character.encode()]
        return [self.unknown]

    def merge(self, text: str) -> list[int]:
        """Ids of one stretch."""
        found: list[int] = []
        for symbol in self.heaped(text):
            number = self.ids.get(symbol)
            found += self._spelled_ids(symbol) if number is None else [number]
        return found

    def heaped(self, text: str) -> list[str]:
        """The symbols of a stretch of any length: the agenda is a heap, its chain is linked."""
        cost = self.costs.get
        symbols: list[str | None] = list(text)
        last = len(symbols) - 1
        before = list(range(-1, last))
        after = [*range(1, last + 1), -1]
        agenda: list[tuple[float, int, int, int]] = []

        def meet(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            price = cost(pair)
            if price is not None:
                heappush(agenda, (price, left, right, len(pair)))

        for left in range(last):
            meet(left, left + 1)
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            # A pair one of whose symbols has changed since is out of date.
            if a is None or b is None or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = a + b, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                meet(left, after[left])
            if before[left] >= 0:
                meet(before[left], left)
        return [symbol for symbol in symbols if symbol is not None]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """All ids of each text, the end id last."""
        prefix = SPACE if self.vocabulary.dummy_prefix else ""
        if self.known.next > REMEMBERED or len(self.pool) > 16 * REMEMBERED:
            self._forget()
        known, findall = self.known, self.stretches.findall
        cut = [findall(prefix + text.replace(" ", SPACE)) if text else [] for text in texts]
        for part in cut:
            part.append("")  # the end
        ends = np.cumsum([len(part) for part in cut])
        numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, ends[-1] if cut else 0)
        new, known.new = known.new, []
        self.learn(new)
        for stretch in new:
            if len(stretch) > SIDE_BY_SIDE_CHARS:
                del known[stretch]
        sizes = self.sizes[numbers]
        behind = np.cumsum(sizes)
        places = np.repeat(self.begins[numbers] - behind + sizes, sizes)
        places += np.arange(len(places))
        flat = self.pool[places]
        borders = [0, *behind[ends - 1].tolist()] if cut else [0]
        encoded = [flat[a:b] for a, b in pairwise(borders)]
        if not self.vocabulary.byte_fallback:
            # Characters without a piece that stand together are one unknown.
            unknown = [ids == self.unknown for ids in encoded]
            encoded = [
                ids[~(u & np.concatenate(([False], u[:-1])))] for ids, u in zip(encoded, unknown, strict=True)
            ]
        return encoded

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids as decimals, joined by one space."""
        return self.decimals[ids].tobytes().translate(None, b"\0")[:-1]

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        """The text of ids; bytes that make up no character become U+FFFD, each."""
        if not len(ids):
            return ""
        kinds = self.vocabulary.kinds
        ids = np.asarray(ids)
        parts = self.bytes_of[ids].tolist()
        inner_control = self.silent[ids[:-1]].any()
        if self.vocabulary.dummy_prefix:
            # The mark that every text begins with goes, if the text begins with a piece.
            for n, i in enumerate(ids):
                if kinds[i] == CONTROL:
                    continue
                if kinds[i] == NORMAL and parts[n].startswith(b" "):
                    parts[n] = parts[n][1:]
                break
        if not inner_control:
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: np.ndarray, parts: list[bytes]) -> str:
        """The text where bytes make up no character, or a control id stands between them."""
        out: list[str] = []
        run = b""
        for i, part in zip(ids.tolist(), parts, strict=True):
            if self.vocabulary.kinds[i] == BYTE:
                run += part
                continue
            out += [_spelled(run), part.decode()]
            run = b""
        return "".join([*out, _spelled(run)])


def _spelled(run: bytes) -> str:
    """A run of bytes, character by character."""
    out: list[str] = []
    at = 0
    while at < len(run):
        lead = run[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            out.append(run[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append(REPLACEMENT)
            at += 1
    return "".join(out)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, about ``SLICE`` characters at a time."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _shared(df: DataFrame, model_path: str):
    """The file and the encoder's tables, some 10 MB, sent to every worker once."""
    with open(model_path, "rb") as file:
        model = file.read()
    # An unsuitable file fails here, not in the tasks.
    state = Encoder(Vocabulary.parse(model)).state()
    return df.sparkSession.sparkContext.broadcast((model, state))


def encode(docs: DataFrame, model_path: str, *, with_ids: bool = True, check: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` (array<int>, the end id last), ``decoded``, ``n_tokens``, both digests
    and ``agrees`` of every document.

    ``model_path`` names a vocabulary file the driver can read. ``ids_sha256`` is the digest of the
    decimal ids joined by one space, ``decoded_sha256`` that of the decoded text in UTF-8.
    ``agrees`` compares with the library, and is NULL without ``check``. Without ``with_ids`` the ids
    and the text stay in the tasks. NULL and empty texts are the end id alone; repeated rows come
    out repeatedly. Only ``doc_id`` and ``text`` are read, so other columns may have any names. An
    empty table gives an empty result. Texts may be of any length, and hold any characters: blanks,
    control characters and U+2581 itself (which decodes to a blank, as in the library) included.
    """
    shared = _shared(docs, model_path)
    fields = [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256")]
    fields += [T.StructField("agrees", T.BooleanType())]
    if with_ids:
        fields += [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    names = [field.name for field in fields]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, state = shared.value
        encoder = Encoder.restored(state)
        library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1).to_pylist()):
                encoded = encoder.encode(texts)
                decoded = [encoder.decode(ids) for ids in encoded]
                same: list[bool | None] = [None] * len(texts)
                if library is not None:
                    theirs = library.encode(
                        texts, add_bos=False, add_eos=True, num_threads=1, return_type="numpy"
                    )
                    back = library.decode(theirs, num_threads=1)
                    same = [
                        np.array_equal(a, b) and c == d
                        for a, b, c, d in zip(encoded, theirs, decoded, back, strict=True)
                    ]
                id_sums = [hashlib.sha256(encoder.decimal(ids)).hexdigest() for ids in encoded]
                columns = [
                    batch.column(0).slice(at, len(texts)),
                    pa.array([len(ids) for ids in encoded], pa.int64()),
                    pa.array(id_sums, pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                    pa.array(same, pa.bool_()),
                ]
                if with_ids:
                    columns += [pa.array(encoded, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(task, T.StructType(fields))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The same rows with ``decoded``, the text of their ``ids``; NULL ids give an empty text.

    A column of that name is replaced. An id that the vocabulary does not have fails the job.
    """
    shared = _shared(encoded, model_path)
    rest = encoded.drop("decoded")
    schema = T.StructType([*rest.schema.fields, T.StructField("decoded", T.StringType())])
    place = rest.columns.index("ids")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.restored(shared.value[1])
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=schema.names
            )

    return rest.mapInArrow(task, schema)
