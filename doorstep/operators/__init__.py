from . import contains, duplicates, quality, same_members, skew

__all__ = ["contains", "duplicates", "quality", "same_members", "skew"]
