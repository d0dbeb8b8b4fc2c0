"""Operators for preparing text training data, each by one fixed method, with their registered queries."""
