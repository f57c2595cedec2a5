"""Registered queries: views over the test tables, one query and one SQL oracle per operator."""
