"""Jobs to run by hand or by a scheduler: each has a function that takes a session, a command line and a configuration file."""
