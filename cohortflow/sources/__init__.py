"""Tables, reports and models on shared storage."""
