"""The batch jobs: silver, gold, their incremental form, and the reports."""
