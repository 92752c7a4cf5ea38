"""Planning workbooks to fact tables, as Spark jobs."""
