"""Files of public tokenizers that queries use; the operators take any path."""

from __future__ import annotations


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
