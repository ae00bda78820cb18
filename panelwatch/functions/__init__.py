from panelwatch.functions import rolling, scalar

__all__ = ["rolling", "scalar"]
