"""The pipeline: staging, market, CRM, targets, reports, quality. Functions from
DataFrames to a DataFrame; they compose into one plan."""
