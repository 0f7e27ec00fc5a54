"""DataFrame-to-DataFrame operators: cleaning, features, fitted transforms, profiling, evaluation."""
