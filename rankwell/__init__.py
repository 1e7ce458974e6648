"""rankwell — explicit-ratings analytics and recommendation as Spark plans.

Ratings stay in long form (user_id, item_id, rating) everywhere; every
operator is a function from DataFrames to a DataFrame so Catalyst sees the
whole plan.  See README.md for the operator map.
"""

__version__ = "0.1.0"
