"""Whole builds: the clickstream model and the ticket KPI set."""
