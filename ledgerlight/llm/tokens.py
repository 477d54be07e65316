"""Public vocabularies, loaded once per Python worker from a folder that is a parameter."""

from __future__ import annotations

import base64
import functools
import os
import re

#: Longest text or white-space run that the fast encoder takes; others go to the reference encoder.
FAST_RUN = 50_000
_RUNS = re.compile(r"\s+|\S+")


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in ``folder``, else where the installed package of public vocabularies keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def byte_bpe_json(folder: str | None = None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json", folder))


@functools.lru_cache(maxsize=4)
def special_strings(folder: str | None = None) -> tuple[str, ...]:
    """Strings that the JSON file's encoder takes for one token wherever a text holds them."""
    return tuple(t.content for t in byte_bpe_json(folder).get_added_tokens_decoder().values())


@functools.lru_cache(maxsize=4)
def byte_bpe_ranks(folder: str | None = None):
    import public_tokenizers
    import tiktoken
    with open(vocabulary_path("byte_bpe_50k.tiktoken", folder), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def piece_bpe(folder: str | None = None):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model", folder))


def encode(text: str, folder: str | None = None) -> list[int]:
    """Ids of ``byte_bpe_50k``, by its faster rank file; texts with very long runs or special strings go to the JSON
    file's encoder, which all of them must agree with."""
    if any(s in text for s in special_strings(folder)):
        return byte_bpe_json(folder).encode(text, add_special_tokens=False).ids
    if len(text) > FAST_RUN and max(m.end() - m.start() for m in _RUNS.finditer(text)) > FAST_RUN:
        return byte_bpe_json(folder).encode(text, add_special_tokens=False).ids
    return byte_bpe_ranks(folder).encode_ordinary(text)
