"""Batch jobs. Each ``run`` builds frames; writing them is a separate step."""
