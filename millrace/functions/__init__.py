from millrace.functions.parsing import split_fields, to_number
from millrace.functions.sampling import hash_bucket
from millrace.functions.states import colour_of, colour_rank, rank_colour
from millrace.functions.vectors import euclidean, nearest, vector_add

__all__ = [
    "colour_of",
    "colour_rank",
    "euclidean",
    "hash_bucket",
    "nearest",
    "rank_colour",
    "split_fields",
    "to_number",
    "vector_add",
]
