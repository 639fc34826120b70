from spindlewatch.plans.reports import COHORTS, daily_vault_failures, hours_by_cohort, rank_vaults, top_models, top_vaults

__all__ = ["COHORTS", "daily_vault_failures", "hours_by_cohort", "rank_vaults", "top_models", "top_vaults"]
