"""The fact table, the analytic questions and the company documents, as lazy plans."""
