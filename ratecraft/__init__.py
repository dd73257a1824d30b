"""ratecraft — ratings analytics and recommendation as Spark jobs.

Every public operator takes and returns DataFrames; column names are
arguments, never hard-coded roles.  Sub-packages:

* ``sources``   — table loading, the ratings data model, file readers/writers
* ``functions`` — column-expression builders (dates, numbers, text, regex, encoding)
* ``operators`` — relational building blocks (projections, joins, aggregates, windows,
  sets, statistics, ranking metrics, corpus statistics)
* ``plans``     — recommenders, regressors, evaluation, stacking and the end-to-end runs
* ``streaming`` — scoring arriving ratings with a fitted model
"""

from ratecraft.session import get_session, checkpoint_dir, scratch_path

__all__ = ["get_session", "checkpoint_dir", "scratch_path"]
