"""Column expressions. All run inside the JVM; nothing here starts a job."""
