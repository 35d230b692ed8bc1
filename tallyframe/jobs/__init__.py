"""Runnable jobs: path in, report, optional path out."""
