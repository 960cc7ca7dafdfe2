"""Staging models, dimensions, facts, reports and the warehouse build."""
