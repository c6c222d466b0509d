from . import dates, json_paths, json_types, periods, predicates, projection, text

__all__ = ["dates", "json_paths", "json_types", "periods", "predicates", "projection", "text"]
