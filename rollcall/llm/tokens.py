"""Token ids of whole texts."""

from __future__ import annotations

import gc
import json
import os
import sys
from array import array
from itertools import islice
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker process keeps encoded, at most; then it goes on with the first, which are the common ones. Longer chunks than
#: KEPT_LETTERS, as texts without blanks have, are encoded each time.
KEPT_CHUNKS, FIRST_CHUNKS, KEPT_LETTERS = 300_000, 180_000, 100
ENDINGS = ".,;:!?"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """Chunks of text and the ids of each, as unsigned 32-bit numbers in the machine's order (little-endian); a chunk is what lies between spaces and line ends.

    This is for tokenizers that drop white space and never join what it parts: the ids of a text are those of its chunks. Each chunk
    is encoded when it is first seen. For a tokenizer with the settings that ``plain`` looks for, a word of Latin letters goes
    straight to the vocabulary model, and marks at its end are encoded apart, as its pattern parts them.
    """

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = plain(json.loads(description))
        self.tokenize, self.letters = self.tokenizer.model.tokenize, byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(ENDINGS) if self.plain else ""
        if word.isalpha() and (word.isascii() or max(word) < "Ā"):
            if word != chunk:
                found = self[word.lower()] + self[chunk[len(word) :]]
            elif not word.islower():
                found = self[word.lower()]
            else:
                letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                found = array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        else:
            found = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= KEPT_LETTERS:
            self[chunk] = found
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, one after the other. The different chunks of all texts are looked up once and then put in place."""
        if len(self) > KEPT_CHUNKS:
            first = list(islice(self.items(), FIRST_CHUNKS))
            self.clear()
            self.update(first)
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts).cast(pa.large_string()), "\n", " "), " ")
        chunks = lists.flatten().dictionary_encode()
        ids = pa.array([self[c] for c in chunks.dictionary.to_pylist()], pa.large_binary()).take(chunks.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8) if len(ids) else np.zeros(1, np.int64)
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [data[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def plain(description: dict) -> bool:
    """Whether letters are lower-cased, runs of letters stand alone, and words become bytes without a mark before them."""
    normal = [n.get("type") for n in (description.get("normalizer") or {}).get("normalizers", [])]
    steps = (description.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and "|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in str((steps[0].get("pattern") or {}).get("Regex"))
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
        and (description.get("model") or {}).get("type") == "BPE"
    )


def word_tokenizer() -> str:
    """Where the public word vocabulary is described."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def worker_encoder(description: str) -> Encoder:
    """The encoder of this worker process, kept from task to task."""
    state = sys.modules.setdefault("rollcall_worker_state", ModuleType("rollcall_worker_state"))
    if getattr(state, "description", None) != description:
        state.description, state.encoder = description, Encoder(description)
        gc.freeze()  # the collector need not look through the chunks again and again
    return state.encoder
