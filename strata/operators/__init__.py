"""DataFrame -> DataFrame operators (cleaning, joins, ordinal, sampling, quality)
and the table-maintenance operators that read and write storage (``tables``)."""
