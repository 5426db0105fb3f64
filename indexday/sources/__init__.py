from indexday.sources.covariates import load_covariates, save_covariates
from indexday.sources.sql import run_sql
from indexday.sources.stages import StageStore, preview, read_stage, save_stage
from indexday.sources.tables import RELATIONS, ContractError, Tables, check_relation, rows_without_date

__all__ = [
    "RELATIONS",
    "ContractError",
    "StageStore",
    "Tables",
    "check_relation",
    "load_covariates",
    "preview",
    "read_stage",
    "rows_without_date",
    "run_sql",
    "save_covariates",
    "save_stage",
]
