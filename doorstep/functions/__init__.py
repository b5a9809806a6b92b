from . import geometry, text

__all__ = ["geometry", "text"]
