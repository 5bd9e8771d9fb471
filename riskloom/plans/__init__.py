"""Feature plans: the wide (194 columns) and the compact (64 columns) applicant matrix."""
