"""Jobs with side effects, and whole runs.

What tasks need of this package travels with their functions, by value: executors and Python
workers do not have to have it installed or on their path.
"""

from pyspark import cloudpickle

from . import checkpoints, heads, objects, parts, stopping, store, tasks

for _module in (checkpoints, heads, objects, parts, stopping, store, tasks):
    cloudpickle.register_pickle_by_value(_module)
