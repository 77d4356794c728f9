"""SentencePiece merge-type encoding by backtracking, and decoding.

A text, normalised by the model, has one valid encoding: the one in which every
two adjacent tokens are what merging their joined text gives. So no merge queue
runs over a text. An Aho-Corasick automaton finds all pieces of a stretch at
once; from the left, the longest piece that starts at a place is tried first,
and it is taken if re-merging it with the token before, along their seam, leaves the
two apart. If
no piece fits, the token before is given back for its next shorter one and the
place is marked in a bitfield: the encoding up to a place is unique, so a place
that failed once has failed for good and is never entered again. Work is linear
in a stretch's pieces, however long it is.

Where no piece holds a space sign behind another character, a text falls apart
before each run of space signs, and between Latin letters and others if no piece
mixes them; the ids of such stretches are remembered up to a bounded number. Characters that are no pieces become their bytes' pieces, or the
unknown id in a model without those.

Defined results: null and empty texts have no tokens; a null doc_id stays null;
repeated rows are encoded each; an empty table gives an empty result; other
columns are ignored. A model of another type than merges is refused.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import small_batches

MODEL = "piece_bpe_32k.model"
CACHED = 500_000
PAIRS = 1_000_000
LONG_STRETCH = 200
# Fixed value: the sign that stands for a space inside pieces.
SPACE_SIGN = "▁"
# Ranges of letters to part from other characters, where a model never mixes them.
_LETTERS = ("A-Za-z\u00c0-\u024f", "A-Za-z")


class MergeEncoder(dict):
    """Ids of texts under a merge-type model; remembers packed ids of stretches."""

    def __init__(self, name: str = MODEL):
        super().__init__()
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        size = self.model.get_piece_size()
        plain = [i for i in range(size) if not (
            self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i)
            or self.model.is_unused(i))]
        self.score = {self.model.id_to_piece(i): self.model.get_score(i) for i in plain}
        self.ids = {self.model.id_to_piece(i): i for i in plain}
        self.bytes = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = self.model.unk_id()
        self.names = list(map(str, range(size)))
        self.has_bytes = all(self.model.is_byte(i) for i in self.bytes)
        self.stretch = self._stretches()
        self.apart: dict[tuple[str, str], bool] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.older: dict[str, bytes] = {}
        self.whole: set[str] = set()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for piece in self.score:
            # A piece that merging never builds would only mislead.
            parts = self.merged(piece, 2)
            if len(parts) < 3 and "".join(parts) == piece:
                self.automaton.add_word(piece)
                self.whole.add(piece)
                if len(parts) == 2:
                    self.halves[piece] = (parts[0], parts[1])
        self.automaton.make_automaton()
        # Whether merges inside a piece are never worse than the one that completes it.
        self.ordered = all(self.score.get(h, math.inf) >= self.score[p]
                           for p, two in self.halves.items() for h in two if len(h) > 1)

    def _stretches(self) -> re.Pattern | None:
        """Pattern of stretches that no piece reaches across, as the model's pieces allow."""
        meet = {two for p in self.score for two in zip(p, p[1:])}
        if any(b == SPACE_SIGN != a for a, b in meet):
            return None
        for letters in _LETTERS:
            one = re.compile(f"[{letters}]")
            if all(bool(one.match(a)) == bool(one.match(b)) for a, b in meet if a != SPACE_SIGN):
                return re.compile(f"{SPACE_SIGN}*[{letters}]+|{SPACE_SIGN}*[^{SPACE_SIGN}{letters}]+|{SPACE_SIGN}+")
        return re.compile(f"{SPACE_SIGN}*[^{SPACE_SIGN}]+|{SPACE_SIGN}+")

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merge adjacent symbols, best score first, the leftmost of equal ones, down to
        ``least`` parts; for short texts."""
        parts = list(text)
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """What stands at one end of a token while it is built: (part, score of the merge that
        takes it up), from the character to the whole."""
        known = self.edges[side].get(token)
        if known is None:
            parts = [token]
            while parts[-1] in self.halves:
                parts.append(self.halves[parts[-1]][side])
            parts.reverse()
            known = self.edges[side][token] = [
                (part, self.score[whole]) for part, whole in zip(parts, parts[1:])] + [(token, -math.inf)]
        return known

    def apart_again(self, left: str, right: str) -> bool:
        """Re-merge two tokens along their seam: does any merge reach across it?"""
        if not self.ordered:
            return self.merged(left + right) == [left, right]
        ends, starts = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (a, taken), (b, given) = ends[i], starts[j]
            across = self.score.get(a + b)
            # Of equal scores the leftmost merge comes first.
            if across is not None and across > taken and across >= given:
                return False
            if taken == given == -math.inf:
                return True
            if taken >= given:
                i += 1
            else:
                j += 1

    def compatible(self, pair: tuple[str, str]) -> bool:
        """Whether two adjacent tokens stay as they are when their text is merged again."""
        if len(self.apart) >= PAIRS:
            self.apart.clear()
        known = self.apart[pair] = self.apart_again(*pair)
        return known

    def tokens(self, text: str) -> list[str]:
        """Pieces of a normalised text; single characters outside the model stand for themselves."""
        size = len(text)
        longest = [0] * size
        for last, length in self.automaton.iter(text):
            longest[last - length + 1] = last + 1
        failed = bytearray(size // 8 + 1)
        apart, pieces = self.apart.get, self.whole
        out: list[str] = []
        at, before = 0, ""
        end = 0  # of the candidate to try, 0 for the longest
        while at < size:
            end = end or longest[at] or at + 1
            while end > at:
                if not failed[end >> 3] >> (end & 7) & 1:
                    token = text[at:end]
                    if not at:
                        break
                    pair = (before, token)
                    fits = apart(pair)
                    if fits or fits is None and self.compatible(pair):
                        break
                # The next shorter piece that starts here; a character always is one.
                end -= 1
                while end > at + 1 and text[at:end] not in pieces:
                    end -= 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                given = out.pop()
                before = out[-1] if out else ""
                end, at = at - 1, at - len(given)
                while end > at + 1 and text[at:end] not in pieces:
                    end -= 1
                # All tokens tried here too: the loop above gives the next one back.
                if end == at:
                    end = -1
                continue
            out.append(token)
            at, before, end = end, token, 0
        return out

    def ids_of(self, text: str) -> list[int]:
        if text in self.whole:
            return [self.ids[text]]
        out: list[int] = []
        for token in self.tokens(text):
            known = self.ids.get(token)
            if known is not None:
                out.append(known)
            elif self.has_bytes:
                out += [self.bytes[b] for b in token.encode()]
            else:
                out.append(self.unknown)
        return out

    def __missing__(self, stretch: str) -> bytes:
        """Remembered in two generations, so that frequent stretches outlast rare ones."""
        ids = self.older.get(stretch) or array("I", self.ids_of(stretch)).tobytes()
        if len(stretch) <= LONG_STRETCH:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[stretch] = ids
        return ids

    def encoded(self, text: str) -> list[int]:
        """Ids of a whole text."""
        normal = self.model.normalize(text)
        stretches = self.stretch.findall(normal) if self.stretch else [normal] if normal else []
        ids = array("I")
        ids.frombytes(b"".join(map(self.__getitem__, stretches)))
        return ids.tolist()

    def decoded(self, ids: list[int]) -> str:
        return self.model.decode(ids) if ids else ""

    def decimals(self, ids: list[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))


_loaded: dict[str, MergeEncoder] = {}


def encoder(name: str = MODEL) -> MergeEncoder:
    """One encoder per worker process."""
    if name not in _loaded:
        _loaded[name] = MergeEncoder(name)
    return _loaded[name]


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                      ("decoded_sha256", pa.string())])
_WHOLE = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _mapped(docs: DataFrame, name: str, schema: pa.Schema, ddl: str, row) -> DataFrame:
    small_batches(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(name)
        for part in parts:
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                ids = model.encoded(text.as_py() or "")
                rows.append((doc_id, *row(model, ids)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ddl)


def encoded(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, ids and the text they decode to, per document."""
    return _mapped(docs, name, _WHOLE, "doc_id long, ids array<int>, decoded string",
                   lambda model, ids: (ids, model.decoded(ids)))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digests(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: no id leaves its task."""
    return _mapped(docs, name, _DIGESTS,
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                   lambda model, ids: (len(ids), _sha(model.decimals(ids)), _sha(model.decoded(ids))))
