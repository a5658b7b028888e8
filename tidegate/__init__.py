"""Write-Audit-Publish pipelines on Spark DataFrames."""
