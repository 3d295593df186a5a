"""The analyses: result tables, report figures, and the job-wide sales cube."""
