"""ratingscope: where film critics and audiences disagree, as Spark jobs.

Every function takes and returns DataFrames (or Columns). Nothing here starts a
session, and no table passes through the driver.
"""
