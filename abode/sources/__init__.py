from abode.sources.landed import guess_types, guessed, misfits, normalise_header, normalise_headers, peek_header, read_landed, read_lookup_csv
from abode.sources.warehouse import warehouse_observations

__all__ = ["normalise_header", "normalise_headers", "peek_header", "read_landed", "read_lookup_csv",
           "warehouse_observations"]
