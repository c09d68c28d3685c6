from duoscope.functions import arrays, names

__all__ = ["arrays", "names"]
