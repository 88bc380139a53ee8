"""Lending and call-centre ETL as reusable Spark DataFrame operators and jobs."""
