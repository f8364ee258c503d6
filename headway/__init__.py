"""Transit-timetable analytics on PySpark."""
