"""Settings with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkConfig:
    """Sizes in estimated tokens, the pause in seconds."""

    child_target: int = 200
    child_min: int = 128
    child_max: int = 256
    child_hard_max: int = 300
    parent_target: int = 800
    parent_min: int = 512
    parent_max: int = 1000
    parents: bool = True
    overlap_tokens: int = 50
    similarity_threshold: float = 0.5
    pause_seconds: float = 3.0


@dataclass(frozen=True)
class StoreConfig:
    """Where the store's tables lie, and the dimension of its vectors."""

    path: str
    dimension: int = 768
    use_quantized: bool = True
