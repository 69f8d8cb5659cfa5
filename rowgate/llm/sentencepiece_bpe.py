"""SentencePiece BPE encoding by backtracking, and decoding.

Merging always joins the adjacent pair whose piece has the best score.  Its
result is the one sequence of pieces in which every two neighbours are
compatible: merging their joined text anew gives these two pieces again.  So a
text is encoded from left to right with the longest piece at each place (all
matches come from one Aho-Corasick pass); a piece that is not compatible with
its left neighbour is shortened, and where none is left the neighbour is taken
back and the place is marked as failed in a bitfield, so that each place fails
once at most.  Compatibility is kept in a bounded table of piece pairs.

No piece holds a blank after another character, so texts are cut at blanks and
each worker keeps the ids of frequent cuts in a bounded cache.  Runs of blanks
(whose pieces have equal scores, so that neighbours don't settle the order) and
nothing else are merged directly.

Decoding looks pieces up by id, joins byte pieces, turns the blank mark into a
space and drops the space that encoding put in front.

Defined cases: a null text is encoded as empty; begin and end ids are always
there; a very long text is encoded whole; every input row gives one result row, repeated
rows and null ids too; the columns read are picked by name, whatever further columns
there are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame

from rowgate.llm.common import map_rows, table, vocabulary

MODEL = "piece_bpe_32k.model"
#: Cuts of a text and pairs of pieces that a worker keeps.
CACHE = 400_000
PAIRS = 500_000
#: Longest cut, in characters, that is kept.
LONGEST = 64
BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_CUT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


class Pieces:
    """The pieces of a model file and the encoder over them."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte pieces is needed")
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("a model with the identity normaliser and a leading blank is needed")
        if any(p.type == _USER for p in proto.pieces) or any(BLANK in p.piece.lstrip(BLANK) for p in proto.pieces if p.type == _NORMAL):
            raise ValueError("pieces that reach across blanks are not supported")
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == _NORMAL}
        self.text = [p.piece for p in proto.pieces]
        self.size = [len(p.piece) for p in proto.pieces]
        #: Characters that are pieces, and neighbours that some piece holds.
        self.known = {p for p in self.ids if len(p) == 1}
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.byte_ids = [0] * 256
        #: What each id stands for in a decoded text.
        self.decoded: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_ids[value] = i
                self.decoded.append(bytes([value]))
            elif p.type == _NORMAL:
                self.decoded.append(p.piece.replace(BLANK, " ").encode())
            else:
                self.decoded.append(proto.trainer_spec.unk_surface.encode() if p.type == _UNKNOWN else b"")
        #: Of each piece, the longest shorter one that it starts with, else -1.
        self.shorter = [-1] * len(self.text)
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1)
        self.matches = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.matches.add_word(p, (len(p), i))
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merging as defined: the best pair first, of equal ones the leftmost."""
        part = list(text)
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        rank = self.rank
        heap = [(rank[part[i] + part[i + 1]], i, part[i] + part[i + 1]) for i in range(len(part) - 1) if part[i] + part[i + 1] in rank]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if part[i] else len(part)
            if j >= len(part) or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, ""
            after[i] = k = after[j]
            if k < len(part):
                before[k] = i
                if (x := both + part[k]) in rank:
                    heapq.heappush(heap, (rank[x], i, x))
            if (k := before[i]) >= 0 and (x := part[k] + both) in rank:
                heapq.heappush(heap, (rank[x], k, x))
        return [p for p in part if p]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' text keeps them: no merge joins a part
        of one with a part of the other, and each becomes itself."""
        part = [*self.text[left], *self.text[right]]
        edge = self.size[left] - 1
        rank, never = self.rank.get, float("inf")
        ranks = [rank(a + b, never) for a, b in zip(part, part[1:])]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            if i == edge:
                return False
            if i < edge:
                edge -= 1
            part[i] += part.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = rank(part[i] + part[i + 1], never)
            if i:
                ranks[i - 1] = rank(part[i - 1] + part[i], never)
        return len(part) == 2

    def backtracked(self, text: str) -> list[int]:
        """Ids of the pieces of a text of known characters."""
        n = len(text)
        longest = [(0, -1)] * n
        for end, match in self.matches.iter(text):
            start = end - match[0] + 1
            if match > longest[start]:
                longest[start] = match
        open_ = bytearray(b"\x01") * (n + 1)
        pairs, size, shorter = self.pairs, self.size, self.shorter
        out: list[int] = []
        at, last, piece = 0, -1, longest[0][1]
        while True:
            while piece >= 0:
                if open_[at + size[piece]]:
                    if last < 0:
                        break
                    key = last << 20 | piece
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self.compatible(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at += size[piece]
                if at == n:
                    return out
                last, piece = piece, longest[at][1]
            else:  # nothing fits here: take the piece before back and shorten it
                open_[at] = 0
                piece = out.pop()
                at -= size[piece]
                last = out[-1] if out else -1

    def encode_cut(self, text: str) -> list[int]:
        """Ids of a text whose blanks are all in front."""
        known = self.known
        if known.issuperset(text) and text[1:2] != BLANK:
            return self.backtracked(text)
        ids: list[int] = []
        i, n = 0, len(text)
        while i < n:
            j = i
            while j < n and text[j] in known:
                j += 1
            if j > i:
                run = text[i:j]
                ids += [self.ids[p] for p in self.merged(run)] if run.startswith(BLANK + BLANK) else self.backtracked(run)
            while j < n and text[j] not in known:
                ids += [self.byte_ids[b] for b in text[j].encode("utf-8")]
                j += 1
            i = j
        return ids


class Codec:
    """Encodes and decodes whole texts, with a bounded cache of their cuts."""

    def __init__(self, model: bytes, cache: int = CACHE) -> None:
        self.pieces = pieces = Pieces(model)
        line_end = array("I", [pieces.byte_ids[10]]).tobytes()
        self.ends = [np.array([i], np.uint32).tobytes() for i in (pieces.begin, pieces.end)]

        class Cuts(dict):
            """From a cut to its ids as little-endian 32-bit integers."""

            def __missing__(self, cut: str) -> bytes:
                # no piece reaches across a line end, nor into most punctuation
                if "\n" in cut and "\n" not in pieces.known:
                    return line_end.join([self[x] if x else b"" for x in cut.split("\n")])
                stem = cut.rstrip(".,;:!?")
                if stem and len(stem) < len(cut) and cut[len(stem) - 1:len(stem) + 1] not in pieces.inside:
                    return self[stem] + self[cut[len(stem):]]
                ids = array("I", pieces.encode_cut(cut)).tobytes()
                if len(cut) <= LONGEST:
                    if len(self) >= cache:
                        self.clear()
                    self[cut] = ids
                return ids

        self.cuts = Cuts()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.frombuffer(self.ends[0] + self.ends[1], "<u4")
        marked = BLANK + text.replace(" ", BLANK)
        body = b"".join(map(self.cuts.__getitem__, _CUT.findall(marked)))
        return np.frombuffer(self.ends[0] + body + self.ends[1], "<u4")

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.pieces.decoded.__getitem__, ids.tolist()))
        # the blank that encoding put in front
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


#: Codecs of this worker process, by model: their caches outlive a task.
_CODECS: dict[bytes, Codec] = {}


def codec_of(model: bytes) -> Codec:
    key = hashlib.sha256(model).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def encode_decode(docs: DataFrame, model: str = MODEL, ids_out: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``;
    with ``ids_out`` also ``ids`` and ``decoded``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    def make():
        codec = codec_of(shared.value)

        def run(rows: dict[str, list]) -> dict[str, list]:
            ids = [codec.encode(t or "") for t in rows["text"]]
            texts = [codec.decode(x) for x in ids]
            return {"doc_id": rows["doc_id"], "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in texts]} | (
                        {"ids": [x.tolist() for x in ids], "decoded": texts} if ids_out else {})

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * ids_out
    return map_rows(docs.select("doc_id", "text"), make, schema)


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
