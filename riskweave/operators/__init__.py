"""DataFrame -> DataFrame operators: cleanse, scoring, joins, enrich, gold,
reports, timeseries, sampling, quality, ml."""
