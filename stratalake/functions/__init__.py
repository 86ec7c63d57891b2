from stratalake.functions.numeric import rounded_product, safe_ratio
from stratalake.functions.ordering import double_of_rank, double_to_rank, rank_to_double
from stratalake.functions.privacy import pseudonymize
from stratalake.functions.rules import bucketize, case_rules, flag_equals, map_values
from stratalake.functions.text import base_name, is_na_token, normalize_text

__all__ = [
    "base_name", "bucketize", "case_rules", "double_of_rank", "double_to_rank", "flag_equals",
    "is_na_token", "map_values", "normalize_text", "pseudonymize", "rank_to_double", "rounded_product",
    "safe_ratio",
]
