"""Permanent identity for records whose natural keys keep changing, on Spark."""
