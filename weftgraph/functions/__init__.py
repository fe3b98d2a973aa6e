from weftgraph.functions.normalize import to_attribute, to_flag, to_integer, trimmed
from weftgraph.functions.scores import rounded, significant, top_k

__all__ = ["rounded", "significant", "to_attribute", "to_flag", "to_integer", "top_k", "trimmed"]
