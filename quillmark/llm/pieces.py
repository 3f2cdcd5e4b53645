"""SentencePiece encoding and decoding with a batched Viterbi search.

A text is cut into words at white space; each distinct word of a batch is encoded once. Words of
equal length advance together, a character per step: hashes of the substrings that end there
probe the sorted keys of the pieces, and the maximum over the best earlier paths is stored with
a backpointer.

In a unigram model each piece may follow each other. In a BPE model a piece may follow another
only if merging their joined characters gives just these two; with that rule one path is left,
the one the merges give, and the same search finds it.

The model file is read by the driver from a path that is a parameter and sent to the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, schemas
from quillmark.llm.words import ragged, slices

SPACE, BASE, CACHE_WORDS, MODEL_BYTES, UNKNOWN_PENALTY = "▁", 0x9E3779B97F4A7C15, 250_000, 64 << 20, 10.0
GROUP_CELLS, JOINT_CODES, SLOT_BITS, SLICE, PAIRS = 1 << 17, 1024, 20, 2 << 20, 500_000


def mixed(hashes: np.ndarray) -> np.ndarray:
    """One to one; spreads short strings over the high bits."""
    with np.errstate(over="ignore"):
        h = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


class Pieces:
    """Vocabulary of a SentencePiece model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.merging = proto.trainer_spec.model_type == 2
        usable = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type in (1, 4)]
        if any(SPACE in p.lstrip(SPACE) for _, p, _ in usable):
            raise ValueError("pieces that cross words are not supported")
        self.score_of = {p: s for _, p, s in usable}
        self.text_of = [p.piece for p in proto.pieces]
        self.scores = np.array([p.score for p in proto.pieces])
        self.unknown_score = min((s for _, _, s in usable), default=0.0) - UNKNOWN_PENALTY
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == 2), 0)
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.longest = max((len(p) for _, p, _ in usable), default=1)
        keys = mixed(np.array([self._hash(p) for _, p, _ in usable], np.uint64))
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([i for i, _, _ in usable], np.int64)[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("piece keys collide; choose another base")
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.array([1, *[BASE] * self.longest], np.uint64), dtype=np.uint64)
        raw = [bytes([int(p.piece[1:-1], 16)]) if p.type == 6 else p.piece.replace(SPACE, " ").encode() if p.type in (1, 4) else b"" for p in proto.pieces]
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_sizes = np.array([len(r) for r in raw], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        # No piece crosses two characters that never stand side by side in one: words are cut there.
        self.joined = np.zeros((JOINT_CODES, JOINT_CODES), bool)
        self.joined[-1, :] = self.joined[:, -1] = True  # codes beyond the table are never cut apart
        for _, text, _ in usable:
            for x, y in zip(text, text[1:]):
                self.joined[min(ord(x), JOINT_CODES - 1), min(ord(y), JOINT_CODES - 1)] = True
        slots = (self.keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.slots = np.searchsorted(slots, np.arange(1 << SLOT_BITS))
        self.chain = int(np.bincount(slots).max()) if len(slots) else 1
        self.follows: dict[int, bool] = {}

    @staticmethod
    def _hash(text: str) -> int:
        total = 0
        for c in text:
            total = (total * BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return total

    def _may_follow(self, pair: int) -> bool:
        """Whether merging the characters of two pieces, best score first, leaves these two."""
        first, second = self.text_of[pair >> 32], self.text_of[pair & 0xFFFFFFFF]
        if first + second in self.score_of:
            return False
        parts, of, none, border = list(first + second), self.score_of.get, -np.inf, len(first)
        scores = [of(a + b, none) for a, b in zip(parts, parts[1:])]
        while len(parts) > 2:
            best = max(scores)
            at = scores.index(best)
            merged = parts[at] + parts[at + 1]
            ahead = sum(map(len, parts[:at]))
            if best == none or ahead < border < ahead + len(merged):
                return False
            parts[at : at + 2] = [merged]
            del scores[at]
            if at:
                scores[at - 1] = of(parts[at - 1] + merged, none)
            if at < len(scores):
                scores[at] = of(merged + parts[at + 1], none)
        return parts == [first, second]

    def allowed(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may follow; -1 is the start or an unknown character and never merges."""
        free = (before < 0) | (piece < 0)
        pairs = np.where(free, -1, before << 32 | piece)
        distinct, at = np.unique(pairs, return_inverse=True)
        known = self.follows
        for p in distinct.tolist():
            if p >= 0 and p not in known:
                known[p] = self._may_follow(p)
        return np.array([p < 0 or known[p] for p in distinct.tolist()], bool)[at].reshape(before.shape)

    def search(self, codes: np.ndarray) -> np.ndarray:
        """Best path of each row of code points, right-aligned: piece ids, -2 for nothing, -2 - end for an unknown character."""
        rows, length = codes.shape
        with np.errstate(over="ignore"):
            prefix = np.zeros((rows, length + 1), np.uint64)
            for i in range(length):
                prefix[:, i + 1] = prefix[:, i] * np.uint64(BASE) + codes[:, i].astype(np.uint64) + np.uint64(1)
            best = np.full((rows, length + 1), -np.inf)
            best[:, 0] = 0
            last, back = np.full((rows, length + 1), -1, np.int64), np.zeros((rows, length + 1), np.int64)
            each = np.arange(rows)
            for i in range(1, length + 1):
                sizes = np.arange(min(self.longest, i), 0, -1)  # the longer piece wins a tie
                hashes = prefix[:, i : i + 1] - prefix[:, i - sizes] * self.powers[sizes]
                piece = self.probe(hashes)
                score = np.where(piece >= 0, self.scores[piece], -np.inf)
                score[:, -1] = np.where(piece[:, -1] < 0, self.unknown_score, score[:, -1])
                score += best[:, i - sizes]
                if self.merging:
                    open_ = score > -np.inf
                    if open_.any():
                        score[open_] = np.where(self.allowed(last[:, i - sizes][open_], piece[open_]), score[open_], -np.inf)
                chosen = np.argmax(score, axis=1)
                best[:, i], last[:, i], back[:, i] = score[each, chosen], piece[each, chosen], sizes[chosen]
        paths, at = np.full((rows, length), -2, np.int64), np.full(rows, length)
        for k in range(length - 1, -1, -1):
            open_ = np.flatnonzero(at > 0)
            if not len(open_):
                break
            piece = last[open_, at[open_]]
            paths[open_, k] = np.where(piece >= 0, piece, -2 - at[open_])
            at[open_] -= back[open_, at[open_]]
        return paths

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 for none; the top bits say where to look among the sorted keys."""
        hashes = mixed(hashes)
        at = self.slots[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        piece = np.full(hashes.shape, -1, np.int64)
        for k in range(self.chain):
            place = np.minimum(at + k, len(self.keys) - 1)
            hit = self.keys[place] == hashes
            piece[hit] = self.key_ids[place[hit]]
        return piece

    def cut(self, text: str) -> list[str]:
        """Parts that no piece crosses; the space mark starts a part unless another stands before it."""
        codes = np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), JOINT_CODES)
        mark = np.frombuffer(text.encode("utf-32-le"), np.uint32) == ord(SPACE)
        codes[codes == JOINT_CODES] = JOINT_CODES - 1
        cuts = ~self.joined[codes[:-1], codes[1:]] | (mark[1:] & ~mark[:-1])
        at = [0, *(np.flatnonzero(cuts) + 1).tolist(), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, those of a word together, and where each word's ids start, and end; words of equal length are searched together."""
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        flat, starts, sizes, total = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        for length, members in by_length.items():
            step = max(1, GROUP_CELLS // length)
            for first in range(0, len(members), step):
                some = members[first : first + step]
                codes = np.frombuffer("".join(words[k] for k in some).encode("utf-32-le"), np.uint32).reshape(len(some), length)
                paths = self.search(codes)
                unknown = np.flatnonzero((paths < -2).any(axis=1))
                spelled = {int(r): self._spelled(words[some[r]], paths[r]) for r in unknown}
                used = paths > -2
                used[unknown] = False
                n = used.sum(axis=1)
                ids = paths[used]
                for r, found in spelled.items():
                    starts[some[r]], sizes[some[r]] = total, len(found)
                    total += len(found)
                    flat.append(found)
                plain = np.ones(len(some), bool)
                plain[unknown] = False
                at = np.array(some)[plain]
                sizes[at] = n[plain]
                starts[at] = total + np.cumsum(n[plain]) - n[plain]
                total += len(ids)
                flat.append(ids)
        return np.concatenate([*flat, np.zeros(0, np.int64)]).astype(np.int32), starts, starts + sizes

    def _spelled(self, word: str, path: np.ndarray) -> np.ndarray:
        """Unknown characters as bytes, or the unknown piece where the model has no bytes."""
        ids: list[int] = []
        for p in path[path != -2].tolist():
            if p >= 0:
                ids.append(p)
            else:
                ids += [self.byte_ids[b] for b in word[-p - 3].encode()] if self.byte_ids else [self.unknown]
        return np.array(ids, np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.piece_sizes[ids]
        raw = self.piece_bytes[ragged(self.piece_starts[ids], sizes)].tobytes()
        return raw[1:] if self.prefix and raw[:1] == b" " else raw


class Encoder:
    """Encodes texts, remembering the words seen; forgets them all when they are too many."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.number, self.starts, self.ends, self.flat = {}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        p = self.pieces
        if len(self.number) > CACHE_WORDS:
            self._forget()
        if len(p.follows) > PAIRS:
            p.follows = {}
        cut = [p.cut(p.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set().union(*cut) - self.number.keys()) if cut else []
        if new:
            flat, starts, ends = p.encode_words(new)
            self.number.update(zip(new, range(len(self.starts), len(self.starts) + len(new))))
            self.starts = np.concatenate([self.starts, starts + len(self.flat)])
            self.ends = np.concatenate([self.ends, ends + len(self.flat)])
            self.flat = np.concatenate([self.flat, flat])
        of = self.number.__getitem__
        found = []
        for words in cut:
            at = np.fromiter(map(of, words), np.int64, len(words))
            found.append(self.flat[ragged(self.starts[at], self.ends[at] - self.starts[at])] if len(at) else np.zeros(0, np.int32))
        return found


def load(path: str) -> bytes:
    """The model file; it must be small enough to be sent to each task."""
    with open(path, "rb") as f:
        model = f.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} has over {MODEL_BYTES} bytes")
    return model


def encode(docs: DataFrame, model_path: str, text_col: str = "text", id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """``_row, doc_id, ids, n_tokens, ids_sha256, decoded_sha256, round_trip`` for each row.

    ``ids`` are the pieces of the whole text (left out unless ``with_ids``). They are decoded
    again; ``round_trip`` says that the decoded bytes are those of the text. It is false only
    for a text with the model's own space mark (U+2581), which decodes to a space, and for bytes
    that are not UTF-8, which count as U+FFFD. A null text
    is empty and has no ids. ``ids_sha256`` is of the ids in decimal, comma-joined. Repeated rows
    and null ids are rows like any other; an empty table gives none; other columns are not read.
    """
    import hashlib

    shipped = docs.sparkSession.sparkContext.broadcast(load(model_path))
    head = "ids array<int>, " if with_ids else ""
    schema, arrow = schemas(
        f"_row long, doc_id {docs.schema[id_col].dataType.simpleString()}, {head}n_tokens long, ids_sha256 string, "
        "decoded_sha256 string, round_trip boolean"
    )

    def run(batches):
        pieces = Pieces(shipped.value)
        encoder = Encoder(pieces)
        names = [str(i) for i in range(len(pieces.text_of))]
        for batch in batches:
            for first, last, data, at in slices(batch.column("text"), SLICE):
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ids = encoder.encode([t.decode("utf-8", "replace") for t in texts])
                decoded = [pieces.decode(i) for i in ids]
                columns = [batch.column("_row")[first:last], batch.column("doc_id")[first:last]]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]))).cast(arrow.field("ids").type))
                columns += [
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join([names[x] for x in i.tolist()]).encode()).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                    pa.array([d == t for d, t in zip(decoded, texts)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
