"""Byte-level BPE: encoding to the exact merges in linear time, and decoding.

A vocabulary file gives every token's bytes and rank.  A text is cut by the pattern of the vocabulary;
each piece is encoded by itself.  Merging pairs by rank is not simulated.  Instead:

* Bytes are mapped to Latin-1 characters, so an Aho-Corasick automaton over strings finds, in one
  scan of a piece, the longest token that begins at each byte.
* Tokens are laid down from left to right, longest first.  A token may stand only where it is
  *compatible* with the token before it: the merges would make exactly these two and not cross the
  border between them.  A sequence whose neighbours are all compatible is the one that merging gives.
  If no token fits, the last one is taken back, and its end is marked: no encoding comes by it again.
  So each place is left at most once, and the work is linear in the piece.
* Compatibility undoes the merges of both tokens, latest first, and looks for a pair across the border
  that would have been merged earlier.  Answers are memoised per pair of tokens.

Ids are packed as little-endian unsigned 32-bit integers.  Encoding and decoding are one pass each,
without a shuffle; a task holds the automaton, two bounded memos and a slice of texts.

Null and empty texts have no ids and decode to no bytes.  Very long texts and pieces are encoded
whole.  Repeated rows and null ids each give their row; an empty table gives no rows.  Other columns
are ignored, so their names cannot clash.  Special tokens are ordinary text.
"""

import base64
import hashlib
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerwatch.llm.batches import map_texts

#: A space before a non-space always begins a new piece of the pattern.
_SPACE = re.compile(r" (?=\S)")


def read_ranks(path):
    """The bytes of a rank file; the driver reads it and tasks get its content."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content):
    """token bytes -> rank, from lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in
            (line.split() for line in content.splitlines() if line.strip())}


class ByteBPE:
    """Encoder and decoder of one vocabulary.

    ``memo_pieces`` and ``memo_pairs`` bound the memos: a full memo is emptied, which costs time only.
    """

    def __init__(self, ranks, pattern, memo_pieces=300_000, memo_pairs=1_000_000):
        import ahocorasick
        import regex

        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.ranks = ranks
        self.tokens = dict(sorted((rank, token) for token, rank in ranks.items()))
        self.find_pieces = regex.compile(pattern).findall
        self.memo_pieces, self.memo_pairs = memo_pieces, memo_pairs
        self.pieces, self.chunks, self.pairs = {}, {}, {}
        self.automaton = ahocorasick.Automaton()
        for rank, token in self.tokens.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        # Of each token: the two it is merged from (itself twice if from none), its next shorter
        # prefix that is a token; and what two tokens merge to.
        self.sizes = {rank: len(token) for rank, token in self.tokens.items()}
        self.parts, self.shorter, self.merged = {}, {}, {}
        for rank, token in self.tokens.items():
            self.parts[rank] = (rank, rank)
            self.shorter[rank] = None
            for cut in range(len(token) - 1, 0, -1):
                left = ranks.get(token[:cut])
                if left is None:
                    continue
                if self.shorter[rank] is None:
                    self.shorter[rank] = left
                right = ranks.get(token[cut:])
                if right is not None and left < rank and right < rank and self._fits(left, right):
                    self.parts[rank] = (left, right)
                    self.merged[left, right] = rank
                    break

    def _fits(self, left, right):
        """Whether merging makes ``left`` and ``right`` side by side, never across their border.

        The latest merge of both sides is undone first.  A pair across the border that would have come
        before it (of equal merges, the one further left comes first) contradicts.
        """
        merged, parts = self.merged, self.parts
        before = 1 << 62  # a pair across the border counts if its rank is below
        while True:
            if merged.get((left, right), 1 << 62) < before:
                return False
            inner, outer = parts[left][1], parts[right][0]
            if inner == left and outer == right:
                return True
            if outer == right or (left > right and inner != left):
                before, left = left, inner
            else:
                before, right = right + 1, outer

    def compatible(self, left, right):
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= self.memo_pairs:
                self.pairs.clear()
            answer = self.pairs[left, right] = self._fits(left, right)
        return answer

    def encode_piece(self, piece):
        """Ids of one piece of bytes."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [None] * len(piece)
        for end, (size, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank  # ends only grow, so the longest comes last
        sizes, shorter, known, upto = self.sizes, self.shorter, self.pairs.get, len(piece)
        dead = set()  # places through which no encoding goes
        out, at, last, token = [], 0, None, longest[0] if piece else None
        while at < upto:
            end = at + sizes[token]
            if end not in dead:
                fits = last is None or known((last, token))
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    at, last = end, token
                    token = longest[at] if at < upto else None
                    continue
            token = shorter[token]
            while token is None:  # nothing fits here: take the last token back, try a shorter one
                dead.add(at)
                at -= sizes[out[-1]]
                token = shorter[out.pop()]
                last = out[-1] if out else None
        return out

    def _packed(self, chunk):
        ids, memo = [], self.pieces
        for piece in self.find_pieces(chunk):
            found = memo.get(piece)
            if found is None:
                found = self.encode_piece(piece.encode())
                if len(piece) <= 64:
                    if len(memo) >= self.memo_pieces:
                        memo.clear()
                    memo[piece] = found
            ids += found
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text):
        """Packed ids of a whole text."""
        memo, out = self.chunks, []
        head, *rest = _SPACE.split(text)
        if head:
            out.append(self._packed(head))
        for chunk in rest:
            ids = memo.get(chunk)
            if ids is None:
                ids = self._packed(" " + chunk)
                if len(chunk) <= 64:
                    if len(memo) >= self.memo_pieces:
                        memo.clear()
                    memo[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, packed):
        """Bytes of packed ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=4)
def _built(digest, pattern, content):
    return ByteBPE(parse_ranks(content), pattern)


def _coder(content, pattern):
    """One coder for each vocabulary of a Python worker."""
    return _built(hashlib.sha256(content).digest(), pattern, content)


def encode(docs, ranks_path, pattern, id_col="doc_id", text_col="text"):
    """(id, ids) of every row: its packed ids."""
    content = read_ranks(ranks_path)

    def make(_, raws):
        coder = _coder(content, pattern)
        return {"ids": pa.array([coder.encode(r.decode("utf-8")) for r in raws], pa.binary())}

    return map_texts(docs, make, "ids binary", id_col, text_col)


def decode(encoded, ranks_path, pattern, id_col="doc_id", ids_col="ids"):
    """(id, ids, decoded) of every row of packed ids: the bytes they stand for; null ids give none."""
    content = read_ranks(ranks_path)
    plain = encoded.select(F.col(id_col).alias("id"),
                           F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def run(batches):
        coder = _coder(content, pattern)
        for b in batches:
            for at in range(0, len(b), 64):
                part = b.slice(at, 64)
                texts = [coder.decode(i.as_py()) for i in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                                 ["id", "ids", "decoded"])

    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, ids binary, decoded binary").withColumnRenamed(
        "id", id_col)
