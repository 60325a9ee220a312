"""Texts to token ids by way of a memo of chunks, for byte-level tokenizers.

A text is cut before a space or a line end that follows a character that is no white space. No
piece of the usual byte-level pattern reaches over such a place, and no entry of the second kind of
vocabulary either (which is checked when it is loaded), so chunks can be encoded one by one, and a
chunk met before is not encoded again. A chunk has one or more streams of numbers (ids of one
tokenizer, of another one, lengths); all chunks' numbers lie in one array per stream, and those of a
text are gathered at once.

The memo (about 200 MB at most) starts anew once it holds ``MEMO`` chunks or ``HELD`` numbers; chunks of more than
``MEMO_CHARS`` characters are looked up within their batch only.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np

from .bpe import SPACE

MEMO = 1_000_000
HELD = 16_000_000
MEMO_CHARS = 64
#: Characters of a text that are cut into chunks at a time.
SPAN = 1 << 20

#: White space but the space and the line end.
_OTHER = [chr(i) for i in range(0x3001) if re.match(f"[{SPACE}]", chr(i)) and chr(i) not in " \n"]
_CUT = re.compile(f"(?<=[^{SPACE}])(?=[ \\n])")


def uneven(text: str) -> bool:
    """Whether a text has white space but single spaces and line ends (two of those only within a text)."""
    return "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text.endswith("\n\n") or any(c in text for c in _OTHER)


def spans(text: str) -> list[str]:
    """A text in parts of about SPAN characters, cut where chunks are."""
    out, at = [], 0
    while len(text) - at > SPAN:
        cut = _CUT.search(text, at + SPAN)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    out.append(text[at:] if at else text)
    return out


class _Keys(dict):
    """Chunk -> its number; a chunk that is met first waits to be asked for. ``lead`` is put before each but those of a line's start."""

    def __init__(self, memo: Chunks, lead: str):
        super().__init__()
        self.memo, self.lead = memo, lead

    def __missing__(self, key: str) -> int:
        m = self.memo
        code = self[key] = m.known + len(m.waiting)
        m.waiting.append(key if key[:1] == "\n" else self.lead + key)
        if len(key) > MEMO_CHARS:
            m.long.append((self, key))
        return code


class Chunks:
    """``ask`` takes chunks and gives, for each stream, the numbers of all of them and how many each has."""

    def __init__(self, ask: Callable[[list[str]], list[tuple[np.ndarray, np.ndarray]]]):
        self.ask = ask
        self.reset()

    def reset(self) -> None:
        self.known, self.waiting, self.long = 0, [], []
        self.spaced, self.plain = _Keys(self, " "), _Keys(self, "")
        self.streams: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def codes(self, text: str) -> np.ndarray:
        """Numbers of the chunks of a text, in order."""
        out = []
        for part in spans(text):
            if uneven(part) or out:
                keys = _CUT.split(part)
                out.append(np.fromiter(map(self.plain.__getitem__, keys), np.int64, len(keys)))
                continue
            first, *rest = part.replace("\n", " \n").split(" ")
            codes = np.fromiter(map(self.spaced.__getitem__, rest), np.int64, len(rest))
            out.append(np.concatenate([[self.plain[first]], codes]) if first else codes)
        return out[0] if len(out) == 1 else np.concatenate(out)

    def settle(self) -> None:
        """Asks for the chunks that wait."""
        if not self.waiting:
            return
        fresh = self.ask(self.waiting)
        if not self.streams:
            self.streams = [(np.empty(0, v.dtype), np.zeros(1, np.int64), np.empty(0, np.int64)) for v, _ in fresh]
        grown = []
        for (values, starts, counts), (v, n) in zip(self.streams, fresh, strict=True):
            starts = np.concatenate([starts, starts[-1] + np.cumsum(n)])
            grown.append((np.concatenate([values, v]), starts, np.concatenate([counts, n])))
        self.streams = grown
        self.known += len(self.waiting)
        self.waiting = []
        for keys, key in self.long:
            del keys[key]
        self.long = []

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Chunk numbers of each text; they hold until the next batch."""
        if self.known > MEMO or any(len(v) > HELD for v, _, _ in self.streams):
            self.reset()
        out = [self.codes(t) if t else np.empty(0, np.int64) for t in texts]
        self.settle()
        return out

    def gather(self, stream: int, codes: np.ndarray) -> np.ndarray:
        """The numbers of a stream of some chunks, one chunk after another."""
        if not len(codes):
            return np.empty(0, np.int64 if not self.streams else self.streams[stream][0].dtype)
        values, starts, counts = self.streams[stream]
        n = counts[codes]
        ends = np.cumsum(n)
        return values[np.repeat(starts[codes] - ends + n, n) + np.arange(ends[-1])]


def byte_table() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, by rule: bytes without a printable sign of their own get the next ones from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def joint(chunks: list[str]) -> tuple[list[int], list[int]]:
    """Numbers of the chunks that may be encoded as one text, as each begins with white space and ends without, and of the others."""
    good, single = [], []
    for i, c in enumerate(chunks):
        (good if c[0] in " \n" and not c[-1].isspace() else single).append(i)
    return good, single


def dealt(ids: np.ndarray, lengths: np.ndarray, chunks: list[str]) -> np.ndarray | None:
    """How many ids each chunk has, if their bytes end where the chunks do."""
    ends = np.cumsum(lengths[ids])
    wanted = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
    at = np.searchsorted(ends, wanted)
    if not len(ends) or at[-1] != len(ends) - 1 or not np.array_equal(ends[at], wanted):
        return None
    return np.diff(at, prepend=-1)


def placed(order: list[int], parts: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of chunks that were asked for in another order."""
    ids, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    if order == list(range(n)):
        return ids, counts
    starts = np.cumsum(counts) - counts
    back = np.argsort(order)
    total = counts[back]
    ends = np.cumsum(total)
    return ids[np.repeat(starts[back] - ends + total, total) + np.arange(len(ids))], total


class ByteLevel:
    """A byte-level tokenizer file of the tokenizers library; ``plain_specials``: its added tokens' spelling is ordinary text.

    Chunks of Latin letters, signs and digits go to tiktoken in one text, with the file's own
    vocabulary as ranks (if its merges are in the order of its ids, else not): its ids are the same and
    it takes a tenth of the time. All others are asked of the library itself.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = () if plain_specials else tuple(added)
        byte, vocab = byte_table(), self.tokenizer.get_vocab()
        ranks = {bytes(map(byte.__getitem__, token)): i for token, i in vocab.items() if token not in added}
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        self.lengths[list(self.bytes_of)] = list(map(len, self.bytes_of.values()))
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        order = [vocab["".join(m)] for m in pairs]
        self.fast = None
        if order == sorted(order) and (file["pre_tokenizer"] or {}).get("use_regex") and not file["normalizer"]:
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids by the library."""
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ask(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        good, single = joint(chunks) if self.fast else ([], list(range(len(chunks))))
        latin = [i for i in good if chunks[i].isascii() or max(chunks[i]) < "\u0250"]
        parts = []
        if latin:
            texts = [chunks[i] for i in latin]
            ids = self.fast.encode_to_numpy("".join(texts), disallowed_special=())
            counts = dealt(ids, self.lengths, texts)
            if counts is None:  # not met; then the library answers
                latin = []
            else:
                parts.append((ids.astype("<u4"), counts))
        rest = single + sorted(set(good).difference(latin))
        if rest:
            got = self.whole([chunks[i] for i in rest])
            parts.append((np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))))
        return placed(latin + rest, parts, len(chunks))
