"""shelfscout: account targeting on Spark.

Dated CRM exports and a large sales fact table go in; a ranked, explained list
of accounts, the checks that guard it and the reports around it come out. Every
step is a function from DataFrames to a DataFrame, so a pipeline is one lazy
plan until something writes it.
"""

from shelfscout.policy import CategoryPolicy, TargetingPolicy

__all__ = ["CategoryPolicy", "TargetingPolicy"]
