"""Exact BPE encoding by per-prefix dynamic programming, and decoding.

A text is normalised and cut into words as the tokenizer file says. For every prefix of
a word exactly one token can be the last of the prefix's encoding: of all tokens that
end there (found by a suffix-linked automaton over the vocabulary, longest first) the
one that is compatible with the last token of the prefix before it. Two tokens are
compatible if no merge would cross their border, which their merge ranks tell. Following
the last tokens back from the word's end gives the ids. New words are sorted, so that a
word takes over the prefixes it shares with the one before.

Ids of words and white-space separated pieces are remembered per Python process, in two
generations of up to MAX_KNOWN: when the younger one is full it becomes the older, and of
that before it only what is asked for comes over. Forgetting changes nothing but time.

Defined cases: a null or empty text has no ids and decodes to the empty text; special
strings inside a text become their ids, as is the library's default; a piece of any
length is encoded whole; repeated rows and ids are encoded row by row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillstar.llm.arrays import held, map_arrow, map_slices, strings

MAX_KNOWN = 200_000
MAX_PAIRS = 300_000
DECODE_IDS = 1 << 18

# How the tokenizer file cuts lower-case text into words.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
# The last character of a word stands for itself with the end mark.
_LAST = 0x400
_NEVER = 1 << 60

_loaded: dict[str, Bpe] = {}


class Bpe:
    """A BPE tokenizer file whose words end in a marked symbol."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        mark = spec["model"]["end_of_word_suffix"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = special
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.names = {i: name for name, i in (vocabulary | special).items()}

        symbols = {}  # vocabulary entry -> its symbols, one character each
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        made = {a + b for a, b in pairs}
        for name in vocabulary:
            if name not in made:
                symbols[name] = name if len(name) == 1 else chr(ord(name.removesuffix(mark)) + _LAST)
        self.parent_pair: dict[int, tuple[int, int, int]] = {}  # token -> (left, right, rank)
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(pairs):
            symbols[a + b] = symbols[a] + symbols[b]
            left, right = vocabulary[a], vocabulary[b]
            self.rank[left, right] = rank
            self.parent_pair[vocabulary[a + b]] = (left, right, rank)
        self.length = {vocabulary[name]: len(s) for name, s in symbols.items()}
        self.id_bytes = {i: i.to_bytes(4, "little") for i in self.names}
        # The decoded bytes of all ids, one after the other, each with a space before it.
        decoded = [b" " + self.names.get(i, "").encode() for i in range(max(self.names) + 1)]
        self.name_data = np.frombuffer(b"".join(decoded), np.uint8)
        self.name_size = np.array([len(x) for x in decoded], np.int32)
        self.name_start = np.cumsum(self.name_size, dtype=np.int32) - self.name_size
        self.goto, self.fail, self.outputs = _automaton({s: vocabulary[name] for name, s in symbols.items()})

        self.left_spine: dict[int, list[tuple[int, int]]] = {}
        self.right_spine: dict[int, list[tuple[int, int]]] = {}
        self.pairs: dict[int, bool] = {}
        # Ids as little-endian unsigned 32-bit integers.
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}
        # The older generation.
        self.old_words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.old_pairs: dict[int, bool] = {}
        self.alone = {t: self._is_own_encoding(t) for t in self.length}

    def _is_own_encoding(self, token: int) -> bool:
        if token not in self.parent_pair:
            return True
        left, right, rank = self.parent_pair[token]
        return self._meets_at(left, right) == rank

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge of `token` while it is built, first to last, each with the
        rank of the merge that takes it up."""
        known = self.left_spine if side == 0 else self.right_spine
        if token not in known:
            spine, consumed = [], _NEVER
            while True:
                spine.append((token if not spine else inner, consumed))
                pair = self.parent_pair.get(spine[-1][0])
                if pair is None:
                    break
                inner, consumed = pair[side], pair[2]
            known[spine[0][0]] = spine[::-1]
        return known[token]

    def _meets_at(self, a: int, b: int) -> int:
        """Rank of the merge that crosses the border of a and b, _NEVER if none does.

        Of equal ranks the leftmost merge comes first."""
        xs, ys = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = xs[i], ys[j]
            rank = self.rank.get((x, y), _NEVER)
            if rank < until_x and rank <= until_y and rank != _NEVER:
                return rank
            if until_x == until_y == _NEVER:
                return _NEVER
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MAX_PAIRS:
                # A copy: a running loop holds the younger one.
                self.old_pairs = dict(self.pairs)
                self.pairs.clear()
            known = self.old_pairs.get(key)
            if known is None:
                known = self._meets_at(a, b) == _NEVER
            self.pairs[key] = known
        return known

    def encode_words(self, words: list[str]) -> None:
        """Add the ids of byte-level words to `self.words`."""
        goto, fail, outputs, alone, length = self.goto, self.fail, self.outputs, self.alone, self.length
        pairs, compatible = self.pairs, self.compatible
        id_bytes, known = self.id_bytes, self.words
        before, states, last = "", [0], [0]
        for word in sorted(words):
            symbols = word[:-1] + chr(ord(word[-1]) + _LAST)
            shared, most = 0, min(len(before), len(symbols))
            while shared < most and before[shared] == symbols[shared]:
                shared += 1
            del states[shared + 1 :], last[shared + 1 :]
            state = states[shared]
            for i in range(shared, len(symbols)):
                symbol = symbols[i]
                following = goto[state].get(symbol)
                while following is None and state:
                    state = fail[state]
                    following = goto[state].get(symbol)
                state = following or 0
                states.append(state)
                for token, size in outputs[state]:
                    start = i + 1 - size
                    if start == 0:
                        if alone[token]:
                            break
                        continue
                    fits = pairs.get(last[start] << 20 | token)
                    if compatible(last[start], token) if fits is None else fits:
                        break
                else:
                    raise ValueError(f"no token ends prefix {i + 1} of {word!r}")
                last.append(token)
            ids, end = b"", len(symbols)
            while end:
                token = last[end]
                ids = id_bytes[token] + ids
                end -= length[token]
            known[word] = ids
            before = symbols

    def split(self, piece: str) -> list[str | int]:
        """A piece without plain spaces as byte-level words and special ids."""
        if "<" in piece and self.special_pattern.search(piece):
            out: list[str | int] = []
            for part in self.special_pattern.split(piece):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self.split(part)
            return out
        if piece.isascii():
            if piece.isalpha():
                return [piece.lower()]
            if piece.isprintable():
                return ASCII_WORDS.findall(piece.lower())
        return [word for word, _ in self.pre_tokenize(self.normalize(piece))]

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that are not known yet."""
        unknown = pieces.difference(self.pieces)
        if len(self.pieces) + len(unknown) > MAX_KNOWN:
            self.old_pieces, self.pieces = self.pieces, {"": b""}
            unknown = pieces.difference(self.pieces)
        if len(self.words) > MAX_KNOWN:
            self.old_words, self.words = self.words, {}
        again = unknown.intersection(self.old_pieces)
        self.pieces.update((piece, self.old_pieces[piece]) for piece in again)
        new = {piece: self.split(piece) for piece in unknown.difference(again)}
        words = {w for parts in new.values() for w in parts if isinstance(w, str)}.difference(self.words)
        again = words.intersection(self.old_words)
        self.words.update((word, self.old_words[word]) for word in again)
        self.encode_words(list(words.difference(again)))
        known, encoded = self.words, self.pieces
        for piece, parts in new.items():
            # Of a single word the very bytes, not a copy of them.
            encoded[piece] = b"".join([known[x] if isinstance(x, str) else self.id_bytes[x] for x in parts])

    def encode(self, texts: list[str]) -> list[tuple[bytes, list[str]]]:
        """Per text: ids as little-endian unsigned 32-bit integers, and its pieces."""
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        self.learn(set().union(*cut))
        known = self.pieces
        return [(b"".join(map(known.__getitem__, pieces)), pieces) for pieces in cut]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the file names no decoder."""
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def decode_pieces(self, pieces: list[str]) -> bytes:
        """The UTF-8 text that the ids of known pieces decode to."""
        return next(self.decode_all([b"".join(map(self.pieces.__getitem__, pieces))]))

    def decode_all(self, encoded: list[bytes]) -> Iterator[bytes]:
        """The UTF-8 texts that ids decode to; about DECODE_IDS ids at once."""
        first = 0
        while first < len(encoded):
            last, size = first, 0
            while last < len(encoded) and (last == first or size + len(encoded[last]) <= 4 * DECODE_IDS):
                size += len(encoded[last])
                last += 1
            ids = np.frombuffer(b"".join(encoded[first:last]), "<u4")
            sizes = self.name_size[ids]
            ends = np.cumsum(sizes, dtype=np.int64)
            at = np.repeat(self.name_start[ids] - (ends - sizes), sizes)
            at += np.arange(len(at))
            data = self.name_data[at].tobytes()
            stops = np.concatenate([[0], ends])[np.cumsum([0] + [len(x) // 4 for x in encoded[first:last]])].tolist()
            for start, stop in zip(stops[:-1], stops[1:], strict=True):
                yield data[start + 1 : stop]
            first = last


def _automaton(tokens: dict[str, int]):
    """(goto, fail, outputs) of the automaton that finds all tokens ending at a position:
    from a state on to goto[state] by symbol or else back to fail[state]; outputs[state]
    lists (token, length), longest first."""
    goto: list[dict[str, int]] = [{}]
    own: list[tuple[int, int] | None] = [None]
    for symbols, token in tokens.items():
        state = 0
        for c in symbols:
            if c not in goto[state]:
                goto[state][c] = len(goto)
                goto.append({})
                own.append(None)
            state = goto[state][c]
        own[state] = (token, len(symbols))
    fail = [0] * len(goto)
    outputs: list[tuple[tuple[int, int], ...]] = [()] * len(goto)
    queue = deque(goto[0].values())
    for state in queue:
        outputs[state] = (own[state],) if own[state] else ()
    while queue:
        state = queue.popleft()
        for c, child in goto[state].items():
            back = fail[state]
            while back and c not in goto[back]:
                back = fail[back]
            fail[child] = goto[back].get(c, 0)
            outputs[child] = ((own[child],) if own[child] else ()) + outputs[fail[child]]
            queue.append(child)

    return goto, fail, outputs


def bpe(path: str) -> Bpe:
    """The tokenizer of this process, loaded once."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
        held["bpe"] = _loaded.clear
    return _loaded[path]


def _id_field(docs: DataFrame, id: str) -> str:
    return f"`{id}` {docs.schema[id].dataType.simpleString()}, "


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): token ids of every text."""

    def run(batch: pa.RecordBatch) -> dict:
        encoded = bpe(path).encode(strings(batch, text).to_pylist())
        return {id: batch.column(0), "ids": id_lists([ids for ids, _ in encoded])}

    return map_slices(docs.select(id, text), run, _id_field(docs, id) + "ids array<int>", text, holds="bpe")


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(x) // 4 for x in encoded]])
    flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def decode(tokens: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text): the texts that token ids stand for; null ids give the empty text."""

    def run(batches):
        for batch in batches:
            rows = [np.array(x or [], "<u4").tobytes() for x in batch.column(1).to_pylist()]
            texts = pa.array([bpe(path).decode(x) for x in rows], pa.string())
            yield pa.RecordBatch.from_pydict({id: batch.column(0), "text": texts})

    return map_arrow(tokens.select(id, ids), run, _id_field(tokens, id) + "text string", "bpe")


def round_trip(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256 (of the ids as little-endian unsigned
    32-bit integers), decoded_sha256 (of the decoded text); `keep` names other columns that
    stay, with_ids adds the ids."""
    schema = _id_field(docs, id) + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batch: pa.RecordBatch) -> dict:
        coder = bpe(path)
        encoded = coder.encode(strings(batch, text).to_pylist())
        sha = hashlib.sha256
        columns = {
            id: batch.column(0),
            "n_tokens": pa.array([len(ids) // 4 for ids, _ in encoded], pa.int64()),
            "ids_sha256": pa.array([sha(ids).hexdigest() for ids, _ in encoded]),
            "decoded_sha256": pa.array([sha(x).hexdigest() for x in coder.decode_all([ids for ids, _ in encoded])]),
        }
        columns |= {c: batch.column(2 + i) for i, c in enumerate(keep)}
        if with_ids:
            columns["ids"] = id_lists([ids for ids, _ in encoded])
        return columns

    return map_slices(docs.select(id, text, *keep), run, schema + ", ids array<int>" * with_ids, text, holds="bpe")
