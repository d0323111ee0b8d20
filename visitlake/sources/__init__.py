"""Where rows come from: raw CSV folders, stored Parquet tables, derived tables."""
