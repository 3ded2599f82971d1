"""Token ids of the public byte-level BPE vocabulary.

The ids are those of the ``tokenizers`` file; they are computed from the same
vocabulary in its ranks form, which merges several times faster, and the
tests hold the two against each other. Added tokens of the file are matched in
texts, as the file's tokenizer does. Vocabulary paths are parameters; the
files stay where they are installed.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1

_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe(json_path: str | None = None) -> Callable[[str], np.ndarray]:
    """text -> little-endian uint32 ids. One encoder per worker process, since
    loading the vocabulary takes longer than a batch."""
    path = json_path or vocabulary_path()
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        with open(path, encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file).get("added_tokens", [])}
        encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

        def encode(text: str) -> np.ndarray:
            try:
                return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
            except ValueError:  # the pattern gives up on white space of a million characters
                return encode_around_long_spaces(text, encoding)

        _ENCODERS[path] = encode
    return _ENCODERS[path]


# Unicode white space, as the tokenizer's pattern has it.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{20000,}")


def encode_around_long_spaces(text: str, encoding) -> np.ndarray:
    """Ids of a text with very long runs of white space. The tokenizer takes
    such a run but for its last character (all of it at the text's end) as one
    piece, so the text can be cut before and after that piece."""
    parts, at = [], 0
    for run in _LONG_SPACE.finditer(text):
        stop = run.end() - (run.end() < len(text))
        parts.append(encoding.encode_to_numpy(text[at:run.start()], allowed_special="all"))
        parts.append(np.array(encoding._encode_single_piece(text[run.start():stop]), np.uint32))
        at = stop
    parts.append(encoding.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(parts).astype("<u4", copy=False)
