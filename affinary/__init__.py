"""affinary: Spark jobs over dated user-item interaction logs.

Every public function takes DataFrames and returns DataFrames (or a small
description of one).  Nothing here plans or executes by itself: Catalyst plans,
Spark executes, and the few driver-side steps read bounded summaries only.
"""
