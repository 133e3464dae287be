from bancalyt.plans.oracle import ORACLE_SQL
from bancalyt.plans.registry import BLOCKS, REGISTRY, QueryDef, catalog_df, run, run_all, run_block

__all__ = ["BLOCKS", "ORACLE_SQL", "QueryDef", "REGISTRY", "catalog_df", "run", "run_all",
           "run_block"]
