"""Fast exact ids of a byte-level BPE tokenizer file.

The merges of such a tokenizer never cross the pieces its pattern cuts, and the
pattern always cuts before a single space, and around a single line feed, between
two characters that are not white space, and between an ASCII letter and the
punctuation after it. A batch of texts is one byte buffer, cut there in numpy; equal
pieces are found by Arrow's dictionary encoding, and only the distinct ones are
encoded. A bounded cache keeps the ids of short pieces for the next batches.

Distinct pieces go through ``tiktoken``, built from the vocabulary of the given
``tokenizers`` file, when the order of the file's merges is that of its ids (byte-level
vocabularies of this kind: the ids are the same, five times faster); else through
``tokenizers`` itself. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

CACHED_PIECES = 250_000
CACHED_BYTES = 24
#: Bytes of text encoded together (a longer text is one step of its own).
STEP_BYTES = 8 << 20
#: The pre-tokenizer's pattern of byte-level files (a fixed value of the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: First bytes of the UTF-8 characters among which other white space is.
_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)


def default_path() -> str:
    """The public byte-level vocabulary of 50,257 ids, as installed on each machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """Byte-level files write each byte as a printable character: itself if it is one,
    else the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids of one piece of text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        order = [vocab[p] for p in pairs]
        pre = spec.get("pre_tokenizer") or {}
        plain = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and not spec.get("normalizer") and order == sorted(set(order)))
        if plain:
            import tiktoken

            byte = _byte_of()
            special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
            self.one = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            self.one = lambda text: t.encode(text, add_special_tokens=False).ids


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Offsets at which the buffer can be cut, with those of the texts and the end."""
    space = _SPACE[data]
    lead = np.flatnonzero(np.isin(data, _LEADS))
    for j in range(3):  # no cut next to what may be other white space
        space[np.minimum(lead + j, len(data) - 1)] = True
    here = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        free = ~space[:-2] & ~space[2:]
        here[1:-2] |= (data[1:-1] == 32) & free
        line = (data[1:-1] == 10) & free
        here[1:-2] |= line
        here[2:-1] |= line
        here[1:-1] |= _LETTER[data[:-1]] & _PUNCT[data[1:]]
    here[starts] = True
    here[len(data)] = True
    return np.flatnonzero(here)


class Ids:
    """Ids of many texts: (flat uint32 ids, number of ids of each text)."""

    def __init__(self, path: str):
        self.one = Encoder(path).one
        self.cache: dict[bytes, bytes] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        steps, step, held = [], [], 0
        for t in texts:
            blob = (t or "").encode("utf-8", "replace")
            if step and held + len(blob) > STEP_BYTES:
                steps.append(self._step(step))
                step, held = [], 0
            step.append(blob)
            held += len(blob)
        steps.append(self._step(step))
        flat, sizes = zip(*steps, strict=True)
        return np.concatenate(flat), np.concatenate(sizes)

    def _step(self, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(b) for b in blobs], dtype=np.int64)
        joined = b"".join(blobs)
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(blobs), np.int64)
        data = np.frombuffer(joined, np.uint8)
        starts = np.concatenate([[0], ends[:-1]])
        at = cuts(data, starts[starts < len(data)])
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(joined)])
        coded = pieces.dictionary_encode()
        distinct, known = coded.dictionary.to_pylist(), self.cache
        found = list(map(known.get, distinct))
        new = {}
        for i, ids_of in enumerate(found):
            if ids_of is None:
                found[i] = new[distinct[i]] = array("I", self.one(distinct[i].decode("utf-8", "replace"))).tobytes()
        if len(known) + len(new) > CACHED_PIECES:
            known.clear()
        known.update((p, i) for p, i in new.items() if len(p) <= CACHED_BYTES)
        flat = np.frombuffer(b"".join(found), np.uint32)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        code = np.asarray(coded.indices)
        n = size[code]
        total = np.cumsum(n)
        shift = (np.cumsum(size) - size)[code] - (total - n)
        out = flat[np.repeat(shift, n) + np.arange(total[-1])]
        upto = np.concatenate([[0], total])[np.searchsorted(at, ends)]
        return out, np.diff(upto, prepend=0)


@lru_cache(maxsize=2)
def ids(path: str | None = None) -> Ids:
    """The tokenizer of this process."""
    return Ids(path or default_path())
