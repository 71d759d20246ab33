"""Results for a hundred seconds of default demand, per zone in order of time.

Every five seconds a row of count, baseline, and the first letter of the status.
"""

ROWS = {
    "Downtown": [
        (20, 20.0, "I"),
        (40, 40.0, "I"),
        (60, 60.0, "I"),
        (124, 60.0, "S"),
        (188, 72.8, "S"),
        (188, 95.84, "N"),
        (236, 114.27, "S"),
        (172, 138.62, "N"),
        (172, 145.29, "N"),
        (60, 150.64, "N"),
        (60, 132.51, "N"),
        (60, 118.01, "N"),
        (124, 106.41, "N"),
        (188, 109.92, "N"),
        (188, 125.54, "N"),
        (236, 138.03, "N"),
        (172, 157.63, "N"),
        (172, 160.5, "N"),
        (60, 162.8, "N"),
        (60, 142.24, "N"),
    ],
    "Airport": [
        (20, 20.0, "I"),
        (40, 40.0, "I"),
        (60, 60.0, "I"),
        (60, 60.0, "N"),
        (84, 60.0, "N"),
        (156, 64.8, "S"),
        (156, 83.04, "N"),
        (132, 97.63, "N"),
        (60, 104.51, "N"),
        (60, 95.6, "N"),
        (60, 88.48, "N"),
        (60, 82.79, "N"),
        (60, 78.23, "N"),
        (84, 74.58, "N"),
        (156, 76.47, "S"),
        (156, 92.37, "N"),
        (132, 105.1, "N"),
        (60, 110.48, "N"),
        (60, 100.38, "N"),
        (60, 92.31, "N"),
    ],
    "Suburb_North": [
        (20, 20.0, "I"),
        (40, 40.0, "I"),
        (60, 60.0, "I"),
        (60, 60.0, "N"),
        (60, 60.0, "N"),
        (100, 60.0, "N"),
        (120, 68.0, "N"),
        (120, 78.4, "N"),
        (80, 86.72, "N"),
        (60, 85.38, "N"),
        (60, 80.3, "N"),
        (60, 76.24, "N"),
        (60, 72.99, "N"),
        (60, 70.39, "N"),
        (100, 68.32, "N"),
        (120, 74.65, "N"),
        (120, 83.72, "N"),
        (80, 90.98, "N"),
        (60, 88.78, "N"),
        (60, 83.03, "N"),
    ],
    "University_Campus": [
        (20, 20.0, "I"),
        (40, 40.0, "I"),
        (60, 60.0, "I"),
        (60, 60.0, "N"),
        (60, 60.0, "N"),
        (60, 60.0, "N"),
        (60, 60.0, "N"),
        (156, 60.0, "S"),
        (156, 79.2, "N"),
        (156, 94.56, "N"),
        (60, 106.85, "N"),
        (60, 97.48, "N"),
        (60, 89.98, "N"),
        (60, 83.99, "N"),
        (60, 79.19, "N"),
        (60, 75.35, "N"),
        (156, 72.28, "S"),
        (156, 89.02, "N"),
        (156, 102.42, "N"),
        (60, 113.14, "N"),
    ],
}
