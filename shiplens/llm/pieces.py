"""The fixed public piece vocabulary (a SentencePiece model file; never trained here)."""

from __future__ import annotations

import os
from functools import lru_cache

import sentencepiece

SPACE = "▁"


def default_model_path() -> str:
    """The installed public vocabulary; callers may pass any other model file."""
    return os.environ.get("PIECE_MODEL_FILE", "/opt/tokenizers/piece_bpe_32k.model")


@lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[str, ...]:
    sp = processor(path)
    return tuple(sp.id_to_piece(i) for i in range(sp.get_piece_size()))


def is_plain(path: str, i: int) -> bool:
    """Whether id ``i`` stands for text (not a control, unknown or byte piece)."""
    sp = processor(path)
    return not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
