from .reader import read_source, typed_rows, values_relation, view_source
from .retail import Retail

__all__ = ["Retail", "read_source", "typed_rows", "values_relation", "view_source"]
