"""leadgrid: lead, company and outreach analytics as Spark DataFrame jobs."""
