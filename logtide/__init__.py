"""logtide: cluster-log and trip analytics as Spark DataFrame operators.

``sources`` read log trees and trip tables, ``functions`` hold the parse
expressions, ``operators`` the analyses, ``plans`` the jobs, sinks and
session helpers, ``streaming`` the same operators over a growing log folder.
"""

__version__ = "0.1.0"
