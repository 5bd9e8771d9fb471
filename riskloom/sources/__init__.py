"""Reading the applicant tables and storing matrices and scores."""
