"""staymill: tabular analytics and model operators for booking-like records on Spark."""
