"""Column expressions. All are Spark built-ins, so they stay inside codegen."""

from clientele.functions.age import AsOf, age_between, age_years, birth_cutoff, flag, has_reached
from clientele.functions.names import full_name

__all__ = ["AsOf", "age_between", "age_years", "birth_cutoff", "flag", "full_name", "has_reached"]
