from rankeval.functions.text import TOKEN_PATTERN, tokens, query_echo, length_norm
from rankeval.functions.signed_rank import upper_tails
from rankeval.functions.stats import nan, safe_div, welch_p_value

__all__ = ["TOKEN_PATTERN", "tokens", "query_echo", "length_norm",
           "nan", "safe_div", "upper_tails", "welch_p_value"]
