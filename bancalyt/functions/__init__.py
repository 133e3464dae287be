from bancalyt.functions.columns import (
    Tier,
    age_years,
    as_of_column,
    count_flags,
    full_name,
    money,
    rule_classify,
    tier_classify,
)

__all__ = ["Tier", "age_years", "as_of_column", "count_flags", "full_name", "money",
           "rule_classify", "tier_classify"]
