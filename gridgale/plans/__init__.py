"""Jobs: operators wired from a source to a sink, and the dashboard queries."""
