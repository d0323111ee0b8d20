"""The eight reports. Each takes the caregiver and visit tables and returns a DataFrame.

All follow one shape: reduce visits to one row per caregiver, drop groups that
are too small, join the caregivers (one row each, so a busy caregiver costs
nothing), label, and keep the top rows. ``limit=None`` returns every row.
"""
