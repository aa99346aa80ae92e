"""End-to-end jobs, each one lazy plan per day range:

* ``daily``   — raw feeds -> clean dataset (flatten, shape, left join, write)
* ``serving`` — clean dataset -> serving table (replace by day, backfill)
* ``reports`` — ad-hoc summaries and dashboard frames over either
"""
