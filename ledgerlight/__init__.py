"""Product and revenue analytics for a subscription business, as Spark DataFrames.

Every public function takes and returns DataFrames and stays lazy; dates that a
database would read from its clock are explicit ``as_of`` arguments.
"""
