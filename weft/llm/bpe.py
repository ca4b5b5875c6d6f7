"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece of bytes there is one token that ends its encoding.
Candidates are the vocabulary's tokens that end there, found along the suffix
links of a suffix automaton of the vocabulary; the longest one that the merges
would leave beside the last token of the shorter prefix is it. Following the
stored last tokens back gives exactly the ids that merging by rank gives.

Memory is bounded by the vocabulary, two memos of ``memo`` pieces each, one of ``PAIRS`` pairs, one of ``HEADS`` beginnings and
a batch of texts; it goes when another operator works in the worker. There is no shuffle: each text is encoded where it is read, so lost
executors cost their own splits only.

Defined results: a null text is encoded as the empty one, which has no ids;
repeated rows give repeated results; texts of any length are encoded whole. Input
columns named as an output are replaced, all others pass through.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_text, table
from .suffix import SuffixAutomaton

#: Pieces in a worker's memo before it becomes the older one and a new one begins; about 300 bytes each.
MEMO = 400_000
#: Pairs of tokens of which a worker remembers whether they stay apart.
PAIRS = 400_000
#: Bytes of a piece's beginning whose prefixes are remembered, and of how many beginnings.
HEAD, HEADS = 7, 150_000
#: Unicode's white space, as in the library's patterns (\x1C-\x1F are none).
WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and the test whether two tokens stay apart."""

    def __init__(self, spec: dict):
        chars = byte_chars()
        model = spec["model"]
        self.special = {}
        for t in spec.get("added_tokens", ()):
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized"):
                raise ValueError(f"added token {t['content']!r}: only plain special tokens are supported")
            self.special[t["content"]] = t["id"]
        ids = model["vocab"]
        self.bytes_of = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes_of[i] = token.encode() if token in self.special else bytes(chars[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.merge: dict[tuple[int, int], int] = {}
        self.rank = array("i", [-1]) * len(self.bytes_of)
        self.parts: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            whole = ids[a + b]
            if whole in self.parts:
                raise ValueError(f"two merges make token {whole}")
            self.merge[ids[a], ids[b]] = r
            self.rank[whole], self.parts[whole] = r, (ids[a], ids[b])
        special = set(self.special.values())
        self._edges: list[dict[int, list[tuple[int, int]]]] = [{}, {}]
        self.usable = {i for t, i in ids.items() if i not in special and self._whole(i)}
        #: What ``apart`` found, by left << 32 | right.
        self.known: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token, then its outermost parts on that side, each with the rank that ends it."""
        if known := self._edges[side].get(token):
            return known
        out, ends, first = [], 1 << 30, token
        while True:
            out.append((token, ends))
            if token not in self.parts:
                self._edges[side][first] = out
                return out
            ends = self.rank[token]
            token = self.parts[token][side]

    def _crossed(self, left: int, right: int, but_whole: bool) -> bool:
        """Whether merging by rank joins a part of ``left`` with a part of ``right``."""
        merge, rights = self.merge.get, self._edge(right, 0)
        for a, a_ends in self._edge(left, 1):
            for b, b_ends in rights:
                r = merge((a, b))
                # of equal ranks the left one merges first
                if r is not None and r < a_ends and r <= b_ends and not (but_whole and a == left and b == right):
                    return True
        return False

    def _whole(self, token: int) -> bool:
        """Whether the merges make this token of its own bytes."""
        todo = [token]
        while todo:
            t = todo.pop()
            if t in self.parts:
                if self._crossed(*self.parts[t], but_whole=True):
                    return False
                todo += self.parts[t]
        return True

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side as they are."""
        if len(self.known) > PAIRS:
            self.known.clear()
        got = self.known[left << 32 | right] = not self._crossed(left, right, but_whole=False)
        return got


class TokenAutomaton:
    """The suffix automaton of all given byte strings, with the tokens that end in each state."""

    def __init__(self, strings: dict[bytes, int]):
        auto = SuffixAutomaton(256)
        ends = {}
        for s, token in strings.items():
            for last in auto.add(s):
                pass
            ends[last] = token
        longest = auto.finish()
        self.step, self.link, self.size = auto.step, auto.link, auto.size
        self.token = array("i", [-1]) * len(auto)
        for s, token in ends.items():
            self.token[s] = token
        self._ending: dict[int, list[tuple[int, int]]] = {-1: []}
        #: The nearest state up the suffix links that is a whole token, else -1.
        self.up = array("i", [-1]) * len(auto)
        for s in reversed(longest):
            self.up[s] = self.link[s] if self.token[self.link[s]] >= 0 else self.up[self.link[s]]

    def ending(self, state: int) -> list[tuple[int, int]]:
        """The tokens that end in this state, longest first, with their lengths."""
        got = self._ending.get(state)
        if got is None:
            got, s = [], state
            while s >= 0:
                if self.token[s] >= 0:
                    got.append((self.token[s], self.size[s]))
                s = self.up[s]
            self._ending[state] = got
        return got


class Bpe:
    """Encoder and decoder of a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str, memo: int = MEMO):
        import regex

        self.most = memo
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab = v = Vocabulary(spec)
        self.auto = TokenAutomaton({v.bytes_of[i]: i for i in sorted(v.usable)})
        self.chunks = re.compile(f" ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+").findall
        self.pieces = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+" + f"| ?[^{WS}\\p{{L}}\\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+"
        ).findall
        specials = sorted(v.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Last tokens of all prefixes of a piece's first ``HEAD`` bytes, with the automaton's state after them.
        self.heads: dict[bytes, tuple[list[int], int, int]] = {}

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of a piece by the unique last token of each of its prefixes."""
        vocab, auto = self.vocab, self.auto
        step, link, size, ending, ended, known = auto.step.get, auto.link, auto.size, auto.ending, auto._ending.get, vocab.known.get
        n_data = len(data)
        # a prefix's last tokens do not depend on what follows: long pieces go on from what their beginnings share
        head = data[:HEAD] if n_data > HEAD else None
        if head and (told := self.heads.get(head)):
            last, state, length = told
            last = last + [0] * (n_data - HEAD)
            begin, head = HEAD, None
        else:
            last, state, length, begin = [0] * (n_data + 1), 0, 0, 0
        for i in range(begin + 1, n_data + 1):
            c = data[i - 1]
            while (to := step(state << 8 | c)) is None and state:
                state = link[state]
                length = size[state]
            state, length = (to, length + 1) if to is not None else (0, 0)
            last[i] = -1
            for t, n in ended(state) or ending(state):
                if n > length:
                    continue
                if n < i:
                    before = last[i - n]
                    if before < 0:
                        continue
                    fits = known(before << 32 | t)
                    if fits is None:
                        fits = vocab.apart(before, t)
                    if not fits:
                        continue
                last[i] = t
                break
            if head and i == HEAD:
                if len(self.heads) >= HEADS:
                    self.heads.clear()
                self.heads[head] = last[: HEAD + 1], state, length
        out, i = [], n_data
        while i:
            if last[i] < 0:
                raise ValueError("the vocabulary lacks single bytes")
            out.append(last[i])
            i -= len(vocab.bytes_of[last[i]])
        return out[::-1]

    def _learn(self, chunk: str) -> bytes:
        memo, older = self.memo, self.older
        out = older.get(chunk)
        if out is None:
            out = b""
            for p in self.pieces(chunk):
                ids = memo.get(p) or older.get(p)
                if ids is None:
                    ids = array("I", self.encode_piece(p.encode("utf-8"))).tobytes()
                    if len(p) <= 64:
                        memo[p] = ids
                out += ids
        if len(chunk) <= 64:
            memo[chunk] = out
        if len(memo) > self.most:  # what was not asked for since the last change is forgotten
            self.memo, self.older = {}, memo
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(array("I", [self.vocab.special[part]]).tobytes())
            elif part:
                get, learn = self.memo.get, self._learn  # learn may begin a new memo: get then only finds less
                out += [get(c) or learn(c) for c in self.chunks(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocab.bytes_of.__getitem__, array("I", ids))).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def load(path: str, memo: int = MEMO) -> Bpe:
    return Bpe(path, memo)


def forget() -> None:
    load.cache_clear()


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of ``text`` as binary: little-endian unsigned 32-bit integers."""
    return map_text(df, lambda: lambda texts: [[load(path).encode(t or "") for t in texts]], f"{out} binary", [text])


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of binary ``ids``; null ids have the empty text."""
    return map_text(df, lambda: lambda rows: [[load(path).decode(x or b"") for x in rows]], f"{out} string", [ids])


def round_trip(df: DataFrame, path: str, text: str = "text", memo: int = MEMO) -> DataFrame:
    """Adds ``ids`` and ``decoded``, the text of these ids, in one pass."""

    def make():
        bpe = load(path, memo)

        def run(texts):
            ids = [bpe.encode(t or "") for t in texts]
            return [ids, [bpe.decode(x) for x in ids]]

        return run

    return map_text(df, make, "ids binary, decoded string", [text])


def digests(df: DataFrame) -> DataFrame:
    """The contract's columns of a ``round_trip``."""
    return df.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {"op8_bpe": op8_bpe}
ORACLE_SQL: dict[str, str] = {}
