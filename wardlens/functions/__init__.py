from .numeric import as_long, clip, numeric_round, row_hash, unit_hash

__all__ = ["as_long", "clip", "numeric_round", "row_hash", "unit_hash"]
