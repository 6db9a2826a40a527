"""Column expressions: text, numbers, prices, probabilities. All stay inside the JVM."""
