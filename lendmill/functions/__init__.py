from lendmill.functions.columns import bucketize, flag_equals, percent, pick
from lendmill.functions.exact import exact_mean, exact_sum

__all__ = ["bucketize", "exact_mean", "exact_sum", "flag_equals", "percent", "pick"]
