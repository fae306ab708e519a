"""Byte-level BPE token ids of whole texts, a batch at a time, with a bounded cache of pieces.

A piece is what stands between two spaces, with the space before it. The tokenizer's own word pattern joins nothing across a space
that a non-space follows, so the ids of a text are the ids of its pieces in turn; texts in which white space or the end follows a space are
encoded whole. Only pieces not in the cache reach the BPE engine, all of a batch in one call. Ids fit in 16 bits (50,257 entries) and are kept that way.
"""

from __future__ import annotations

from collections.abc import Iterator

from .common import kept

#: Pieces kept in a worker; beyond the bound the cache starts anew, so memory is bounded and results are the same.
CACHE_PIECES = 500_000
#: Texts are handled in slices of so many bytes, or one text if it is longer.
SLICE_BYTES = 12 << 20
VOCABULARY = "byte_bpe_50k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary in a worker."""
    return kept(("encoder", path), lambda: Encoder(path))


def _bytes_of_marks() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def slices(column, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of slices of a string array, each of about `most` bytes, or one text if it is longer."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop - start
        start = stop


class Encoder:
    """Reads the vocabulary file; its ids are in order of its merges, so they serve the BPE engine as ranks. Special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str):
        import json

        import numpy as np
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        marks = _bytes_of_marks()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(marks[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.engine = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 16-bit numbers."""
        import numpy as np

        return np.asarray(self.engine.encode_ordinary(text), dtype="<u2").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces in one call and cut the ids where the pieces end: no id spans two pieces."""
        import numpy as np

        if not pieces:
            return
        ids = self.engine.encode_to_numpy(" " + " ".join(pieces), disallowed_special=()).astype(np.int64)
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(x.encode()) + 1 for x in pieces]), side="right")
        flat, at = ids.astype("<u2").tobytes(), 0
        for x, end in zip(pieces, ends.tolist(), strict=True):
            self.cache[x] = flat[2 * at : 2 * end]
            at = end

    def encode_batch(self, texts):
        """Ids of each text as a binary array; texts: a pyarrow string array. Null: no ids."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values[offsets[0] : offsets[-1]].dictionary_encode()
        offsets = offsets - offsets[0]
        pieces, where = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        head = pc.utf8_slice_codeunits(coded.dictionary, 0, 1)
        whole = pc.or_(pc.equal(head, ""), pc.utf8_is_space(head)).to_numpy(zero_copy_only=False)
        known = self.cache
        table = list(map(known.get, pieces))
        new = [x for x, ids in zip(pieces, table, strict=True) if ids is None]
        if new:
            self._learn([x for x in new if x and not x[0].isspace()])
            table = [known.get(x, b"") if ids is None else ids for x, ids in zip(pieces, table, strict=True)]
        starts = offsets[:-1]
        bad = whole[where]
        bad[starts] = False  # what stands first has no space before it
        odd = np.add.reduceat(bad, starts) > 0 if len(where) else np.zeros(0, bool)
        firsts = [self.encode(x) for x in lists.values.take(pa.array(lists.offsets.to_numpy()[:-1])).to_pylist()]
        table.append(b"")
        for d in np.flatnonzero(odd).tolist():
            firsts[d] = self.encode(texts[d].as_py())
            where[starts[d] : offsets[d + 1]] = len(pieces)
        where[starts] = len(table) + np.arange(len(starts))
        ids = pa.array(table + firsts, pa.binary()).take(pa.array(where, pa.int32()))
        bounds = np.frombuffer(ids.buffers()[1], dtype=np.int32, count=len(where) + 1)[offsets] if len(where) else np.zeros(1, np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(bounds)), ids.buffers()[2]]) if len(texts) else pa.array([], pa.binary())
